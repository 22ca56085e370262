"""Ranked search, nearest neighbours and conversation repair against plain Python."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import LONG, SF_DIR, no_docs, odd_docs, real_docs
from pyspark.sql import functions as F

from lodestone.llm import conversation_repair as repair
from lodestone.llm.nearest import distances, nearest, op12_nearest
from lodestone.llm.queries import ORACLE_SQL, QUERIES
from lodestone.llm.ranked_search import ranked
from lodestone.llm.scratch import Scratch
from lodestone.llm.topk import first_rows
from oracle.compare import connect, differences


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


@pytest.mark.parametrize("name", ["op11_ranked_search", "op13_conversation_repair"])
def test_query_gives_what_its_sql_gives(spark, name):
    assert not differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE_SQL[name])


def test_first_rows_of_a_hot_key(spark):
    rows = spark.range(50_000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 7).alias("k"), (F.col("id") * 7919 % 50_021).alias("v"))
    got = {(r.k, r["rank"], r.v) for r in first_rows(rows, ["k"], [F.desc("v")], 5).collect()}
    held = {}
    for r in rows.collect():
        held.setdefault(r.k, []).append(r.v)
    assert got == {(k, i + 1, v) for k, vs in held.items() for i, v in enumerate(sorted(vs, reverse=True)[:5])}


# ---- ranked search ------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_ranked(docs, items, k=20):
    held = [(doc_id, Counter(words(text))) for doc_id, text in docs]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    wanted = {}
    for item, text in set(items):
        wanted.setdefault(item, Counter()).update(words(text))
    out = []
    for item, terms in wanted.items():
        scored = []
        for (doc_id, counts), n in zip(held, sizes, strict=True):
            score = 0
            for term, times in terms.items():
                if tf := counts[term]:
                    m = 75 + (25 * n * n_docs) // total
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += times * weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ITEMS = "item_id long, text string, SCORE int, `rank` string"


def test_ranked_odd_documents_and_items(spark, scratch):
    items = [(1, "One TWO, two three"), (1, "One TWO, two three"), (1, "four"), (2, None), (3, ""), (4, " .,! "), (None, "nothing É é"), (5, LONG), (6, "日本語 テキスト line")]
    frame = spark.createDataFrame([(*i, 0, "x") for i in items], ITEMS)
    docs = odd_docs(spark)
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    # Long items of hundreds of terms, chunks of few documents, and items in several passes.
    for options in ({}, {"block_terms": 40}, {"chunk_docs": 1}):
        assert rows_of(ranked(docs, frame, Scratch(spark, "t"), **options)) == plain_ranked(plain, items)
    assert rows_of(ranked(no_docs(spark), frame, scratch)) == []
    assert rows_of(ranked(docs, frame.limit(0), Scratch(spark, "t"))) == []


def test_ranked_many_equal_and_few_best(spark, scratch):
    rng = random.Random(5)
    common = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choices(common, k=rng.randint(1, 9)) + ([f"r{rng.randint(0, 40)}"] if rng.random() < 0.2 else [])) for _ in range(3_000)]
    docs = [(i // 2, t) for i, t in enumerate(texts + ["w1 w2 r7"] * 500)]
    items = [(i, " ".join(rng.choices(common, k=5) + [f"r{rng.randint(0, 40)}"] * 2)) for i in range(15)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = rows_of(ranked(frame, spark.createDataFrame(items, "item_id long, text string"), scratch, k=7))
    assert got == plain_ranked(docs, items, k=7)


def test_ranked_real_documents_by_text_ids(spark, scratch):
    docs = real_docs(spark)
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").withColumn("item_id", F.concat(F.lit("i"), "item_id"))
    got = rows_of(ranked(docs, items, scratch))
    assert got == plain_ranked([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


# ---- nearest neighbours -------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, score string, label int"


def frame_of(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1) for i, v in vectors], VECTORS)


def plain_nearest(vectors, query, k):
    own, asked = query
    far = sorted((float(np.linalg.norm(np.array(v) - asked)), i) for i, v in vectors if i != own and v is not None and len(v) == len(asked))
    return far[:k]


def test_nearest_finds_nine_of_ten(spark, scratch):
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(40, 48))
    x = np.concatenate([middles[rng.integers(0, 40, 5_000)] + rng.normal(size=(5_000, 48)) * 0.3, rng.normal(size=(1_000, 48)) * 3])
    vectors = [(i, list(v)) for i, v in enumerate(x)]
    df = frame_of(spark, vectors)
    queries = df.where("vec_id % 100 = 0")
    rows = nearest(df, queries, scratch, block=25, chunk=1_500, sample=500).collect()
    found = {}
    for r in rows:
        found.setdefault(r.query_id, {})[r["rank"]] = (r.score, r.vec_id)
    hits = 0
    assert len(found) == 60
    for query, ranks in found.items():
        assert sorted(ranks) == list(range(1, 11)) and [ranks[i] for i in range(1, 11)] == sorted(ranks.values())
        for score, other in ranks.values():
            assert score == pytest.approx(np.linalg.norm(x[query] - x[other]), rel=1e-12)
        hits += len({i for _, i in ranks.values()} & {i for _, i in plain_nearest(vectors, (query, x[query]), 10)})
    assert hits / 600 >= 0.9


def test_nearest_of_the_given_vectors(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    vectors = [(r.vec_id, r.embedding) for r in rows]
    got = {}
    for r in op12_nearest(spark, SF_DIR).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    wanted = {i: {j for _, j in plain_nearest(vectors, (i, np.array(v)), 10)} for i, v in vectors if i % 100 == 0}
    assert sum(len(got[i] & wanted[i]) for i in wanted) >= 0.9 * sum(map(len, wanted.values()))


def test_nearest_odd_vectors(spark, scratch):
    nan, inf = float("nan"), float("inf")
    odd = [(200, None), (300, []), (400, [0.0, 0.0]), (500, [1.0, None]), (600, [nan, 1.0]), (700, [inf, 1.0]), (800, [1.0, 2.0, 3.0])]
    fine = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1e-200, 1e-200]), (3, [2e-200, 1e-200]), (4, [1e300, -1e300]), (None, [1.0, 0.0]), (900, [3e-200, 1e-200])]
    df = frame_of(spark, odd + fine)
    got = {}
    for r in nearest(df, df.where("vec_id % 100 = 0 or vec_id is null"), scratch).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {0, 100, 900}
    assert [v for _, v, _ in sorted(got[0])] == [1, 1, None, 2, 3, 900, 100, 4]
    near = sorted(got[900])[:2]
    assert [v for _, v, _ in near] == [3, 2] and near[0][2] == pytest.approx(1e-200) and near[1][2] == pytest.approx(2e-200)
    assert sorted(got[0])[-1][2] == pytest.approx(math.sqrt(2) * 1e300)
    none = nearest(df.limit(0), df, Scratch(spark, "t"))
    assert none.collect() == [] and none.columns == ["query_id", "rank", "vec_id", "score"]


def test_nearest_of_many_copies_takes_the_smallest_ids(spark, scratch):
    rng = np.random.default_rng(4)
    vectors = [(i, [0.1] * 16 if i % 3 == 0 else list(rng.normal(size=16))) for i in range(6_000)]
    got = nearest(frame_of(spark, vectors), frame_of(spark, vectors[:1]), scratch, chunk=1_000)
    assert [(r.vec_id, r.score) for r in got.orderBy("rank").collect()] == [(3 * i, 0.0) for i in range(1, 11)]


def test_distances_leave_no_range():
    x = np.array([[1e200, 1.0], [1e-200, 0.0], [3.0, 4.0]])
    assert distances(x, np.zeros(2)) == pytest.approx([1e200, 1e-200, 5.0], rel=1e-15)


# ---- conversation repair ------------------------------------------------------------------------------------

GRAMMAR = re.compile(r"(s?(ua)+)?")


def plain_repair(turns):
    """(cost, audit) of the cheapest edits; turns as (initial, state). States of the grammar, one turn after another."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "")}

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                for letter in after[state].replace("s", ""):
                    way = (cost + 3, audit + "I")
                    if letter not in best or way < best[letter]:
                        best[letter] = way
        return best

    for role, state in turns:
        new = {}
        for at, (cost, audit) in inserted(dict(best)).items():
            ways = [(at, (cost + 4, audit + "D"))]
            if state != "x":
                stay = 3 if state == "-" else 0
                ways += [(letter, (cost + stay, audit + "K")) for letter in after[at] if letter == role]
                ways += [(letter, (cost + stay + 3, audit + "R")) for letter in after[at] if letter != "s"]
            for to, way in ways:
                new[to] = min(new.get(to, way), way)
        best = new
    return min(best_of for to, best_of in inserted(best).items() if to in ("", "a"))


def made_by(turns, audit):
    """The initials that an audit makes, by the roles alone."""
    made, at = "", 0
    for edit in audit:
        if edit != "I":
            role, at = turns[at][0], at + 1
        if edit != "D":
            made += role if edit == "K" else "ua"[len(made.replace("s", "")) % 2]
    return made


@pytest.mark.parametrize("count", range(5))
def test_alignment_of_all_short_conversations(count):
    for turns in itertools.product([(r, s) for r in "sua " for s in ".-x"], repeat=count):
        if count == 4 and random.Random(repr(turns)).random() > 0.1:
            continue
        group = [{"conv_key": "c", "part": 0, "place": i, "fault": None, "code": "".join(t)} for i, t in enumerate(turns)]
        if not group:
            continue
        rows = repair._whole(group)
        audit, made = "".join(r[4] for r in rows), "".join(r[5] for r in rows)
        cost = 4 * audit.count("D") + 3 * (audit.count("I") + audit.count("R"))
        left = [t for t, r in zip(turns, rows, strict=True) if "D" not in r[4]]
        assert (cost + 3 * sum(s == "-" for _, s in left), audit) == plain_repair(turns)
        assert GRAMMAR.fullmatch(made) and made == made_by(turns, audit)


def some_turns(rng, count):
    roles = ["system" if i == 0 and rng.random() < 0.3 else ("user", "assistant")[i % 2] for i in range(count)]
    roles = [rng.choice(["system", "user", "assistant", "tool", None]) if rng.random() < 0.15 else r for r in roles]
    texts = [rng.choice(["Fine.", "cut", "  ", "", "Ja! \n", "x" * 50 + "?", None, f"T{rng.randint(0, 9)}."]) if rng.random() < 0.3 else f"Turn {i}." for i in range(count)]
    return list(zip(roles, texts, strict=True))


def plain_summary(rows):
    """Of one conversation's (turn, role, text) in order, what the operator sums up."""
    seen, turns, faults = set(), [], Counter()
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        faults[fault] += 1
        turns.append((role[:1] if role[:1] in ("s", "u", "a") else " ", {"truncated": "-", None: "."}.get(fault, "x")))
    cost, audit = plain_repair(turns)
    made, at, lines = made_by(turns, audit), 0, []
    letters = iter(made)
    for edit in audit:
        role, text = rows[at][1:] if edit != "I" else ("", "")
        at += edit != "I"
        if edit != "D":
            letter = next(letters)
            lines.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[letter]}:{text}")
    known = sorted({t for t, _, _ in rows if t is not None})
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    gaps = known[-1] - known[0] + 1 - len(known) if known else 0
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest


TURNS = "conv_id long, turn long, role string, text string, PART int, `place` string"


@pytest.mark.parametrize("block", [2, 7, 512])
def test_repair_whatever_the_blocks(spark, block):
    """Also conversations that lie in several tasks, longer than many blocks, and with null ids and turns."""
    rng = random.Random(block)
    wanted, rows = {}, []
    for conv in [None, *range(40)]:
        turns = some_turns(rng, 900 if conv == 3 else rng.randint(1, 12))
        # Of one turn only one row, so that the order is known; null turns come first.
        numbered = [(None if i == 0 and conv in (5, None) else i + (i > 4), *t) for i, t in enumerate(turns)]
        wanted[None if conv is None else f"c{conv}"] = plain_summary(numbered)
        rows += [(conv, *t, 0, "x") for t in numbered]
    rng.shuffle(rows)
    found = repair.summaries(repair.repaired(spark.createDataFrame(rows, TURNS), Scratch(spark, "t"), block=block)).collect()
    assert {r.conv_key or None: tuple(r)[1:] for r in found} == wanted


def test_repaired_rows_of_repeats_and_empty_tables(spark, scratch):
    rows = [(1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yo."), (1, 3, "system", "Late."), (2, None, None, None)]
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], TURNS)
    got = [(r.conv_id, r.text, r.fault, r.edits, r.made) for r in repair.repaired(frame, scratch).collect()]
    assert sorted(got, key=repr) == [
        (1, "Hi.", "duplicate", "D", ""), (1, "Hi.", None, "K", "u"), (1, "Late.", None, "D", ""), (1, "Yo.", None, "K", "a"), (2, " ", "blank", "D", ""),
    ]
    nothing = repair.repaired(frame.limit(0), Scratch(spark, "t"))
    assert nothing.collect() == [] and repair.summaries(nothing).collect() == []


def test_one_conversation_of_most_rows_is_spread(spark, scratch):
    """A conversation of 30,000 turns, a third of them one and the same row."""
    turns = [(i, "user" if i % 2 == 0 else "assistant", "Same." if i % 3 == 0 else f"Turn {i}.") for i in range(30_000)]
    frame = spark.createDataFrame([(1, *t) for t in turns], "conv_id long, turn long, role string, text string")
    placed = repair._located(frame, repair.BLOCK)
    sizes = [r["count"] for r in placed.groupBy("part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 20_000
    found = repair.summaries(repair.repaired(frame, scratch)).collect()[0]
    assert tuple(found)[1:] == plain_summary(turns)

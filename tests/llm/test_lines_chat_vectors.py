"""Line dedup, role repair and embedding near-dedup against plain Python."""

import itertools
import math
import random
import re
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
import xxhash
from llm_cases import SF_DIR, no_docs, odd_docs, real_docs

from lodestone.llm import chat
from lodestone.llm.embedding_dedup import ROOTS, decode, near_vectors
from lodestone.llm.line_dedup import DISTANCE, LONG_CHARS, SIMILARITY, line_rows, without_repeated_lines
from lodestone.llm.queries import QUERIES
from lodestone.llm.scratch import Scratch


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


# ---- lines --------------------------------------------------------------------------------------------------

CHARACTERS = str.maketrans(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "123456789" + "\t\r\x0b\x0c", "abcdefghijklmnopqrstuvwxyz" + "0" * 9 + " " * 4, ".,;:!?\"'()[]{}<>|*_#"
)


def normal(line):
    return line.translate(CHARACTERS).strip(" ")


def plain_print(line):
    hashes = [xxhash.xxh64_intdigest(w, 42) for w in set(line.split(" ")) if w]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def plain_lines(docs):
    """Kept text by doc; documents in order of id, hash of the text and line."""
    rows = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    lines = {(r, i): normal(line) for r in rows if r[2] is not None for i, line in enumerate(r[2].split("\n"))}
    texts = sorted({t for t in lines.values() if t})
    prints = {t: plain_print(t) for t in texts}
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for a, b in itertools.combinations(texts, 2):
        if (prints[a] ^ prints[b]).bit_count() <= DISTANCE and find(a) != find(b):
            longest = max(len(a), len(b))
            if min(len(a), len(b)) >= math.floor(longest * SIMILARITY) and edits(a, b) <= math.floor(longest * (1 - SIMILARITY) + 1e-9):
                parent[find(a)] = find(b)
    first, out = {}, {}
    for r in rows:
        if r[2] is None:
            out[r] = (None, ())
            continue
        gone = []
        for i, line in enumerate(r[2].split("\n")):
            if lines[r, i] and first.setdefault(find(lines[r, i]), (r, i)) != (r, i):
                gone.append(i)
        out[r] = ("\n".join(t for i, t in enumerate(r[2].split("\n")) if i not in gone), tuple(gone))
    return out


def with_hash(spark, docs):
    from pyspark.sql import functions as F

    return [(r.doc_id, r.h, r.text) for r in docs.select("doc_id", F.xxhash64("text").alias("h"), "text").collect()]


def near_docs(spark):
    random.seed(4)
    word = lambda: "".join(random.choice("abcdefg") for _ in range(random.randrange(2, 8)))
    base = [" ".join(word() for _ in range(random.choice([1, 3, 12, 40]))) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(5):
            words = random.choice(base).split(" ")
            if random.random() < 0.6:
                at = random.randrange(len(words))
                words[at : at + 1] = random.choice([[], [word()], [words[at], word()], [words[at].upper() + ","]])
            lines.append(" ".join(words))
        rows.append((i, "\n".join(lines)))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("make", [odd_docs, near_docs, no_docs])
def test_lines_like_all_pairs(spark, scratch, make):
    docs = make(spark)
    found = without_repeated_lines(docs, scratch)
    expected = plain_lines(sorted(set(with_hash(spark, docs)), key=str))
    ours = {(r.doc_id, r.text, tuple(r.dropped)) for r in found.collect()}
    assert ours == {(r[0], text, gone) for r, (text, gone) in expected.items()}
    assert found.count() == docs.count() and found.columns == [*docs.columns, "dropped"]


def test_prints_of_lines_of_any_length(spark):
    random.seed(3)
    texts = [" ".join(f"w{random.randrange(10**6)}" for _ in range(n)) for n in (1, 2, 3, 127, 300, 9_000)]
    texts += ["a " * 32_760, "b " * 40_000, "c  d\te, F9"]
    assert max(map(len, texts)) > LONG_CHARS
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.print % (1 << 64) for r in line_rows(docs).collect()} == {i: plain_print(normal(t)) for i, t in enumerate(texts)}


def test_line_query_digests(spark):
    rows = QUERIES["op5_line_dedup"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in real_docs(spark).collect()}
    assert len(rows) == len(texts)
    for r in rows:
        gone = {int(n) for n in r.dropped.split(",") if n}
        kept = "\n".join(t for i, t in enumerate(texts[r.doc_id].split("\n")) if i not in gone)
        assert r.text_sha256 == sha256(kept.encode()).hexdigest() and r.n_dropped == len(gone) and r.n_chars_kept == len(kept)


# ---- chat ---------------------------------------------------------------------------------------------------


def cheapest(roles):
    """All legal sequences, turn by turn, with every insertion of up to three turns."""
    costs = {chat.START: 0.0}
    for role in roles:
        after = {}
        for state, cost in costs.items():
            for n in range(4):
                for path in itertools.product((1, 2, 3), repeat=n):
                    at, legal = state, True
                    for step in path:
                        legal &= step in chat.NEXT[at]
                        at = step
                    for to in (1, 2, 3) if legal else ():
                        change = cost + n * chat.INSERT + (0 if to == role else chat.RELABEL)
                        if to in chat.NEXT[at]:
                            after[to] = min(after.get(to, math.inf), change)
                        if not n and to == state:
                            after[to] = min(after.get(to, math.inf), change + chat.MERGE)
        costs = after
    return min(cost + chat.CLOSE[state][0] for state, cost in costs.items())


def conversations(spark):
    random.seed(3)
    rows, names = [], ["user", "assistant", "system", " User", "tool", None]
    for conv in range(30):
        for i in range(random.choice([1, 2, 3, 5, 8, 70, 300])):
            text = None if random.random() < 0.1 else f"t{i} <|user|> x"
            rows.append((conv or None, None if random.random() < 0.02 else i, random.choice(names), text, 1))
    rows += [(99, -5, "assistant", "early", 1), (99, 5_000_000, "user", "late", 1), (98, 1, "user", "same", 1), (98, 1, "user", "same", 1)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place int")


def test_repair_costs_least_and_renders_legally(spark, scratch):
    turns = conversations(spark)
    by_conv = defaultdict(list)
    for r in chat.rendered(turns, scratch).collect():
        by_conv[r.conv_key].append(r)
    assert sum(map(len, by_conv.values())) == turns.count() and len(by_conv) == 32
    for rows in by_conv.values():
        rows.sort(key=lambda r: (r.place.null_turn, r.place.turn or 0, r.place.role_no, r.place.text_hash, r.place.id))
        assert sum(r.cost + (r.end_cost or 0) for r in rows) == pytest.approx(cheapest([r.place.role_no for r in rows]))
        text = "".join(r.fragment for r in rows) + rows[-1].closing
        heads = re.findall(r"<\|(system|user|assistant)\|>\n", text)
        assert re.fullmatch("s?(ua)*", "".join(h[0] for h in heads)) and text.count(chat.TAIL) == len(heads)
        assert all((r.closing is None) == (r is not rows[-1]) for r in rows)
        assert all((r.text or "").replace("<|", "< |") in text for r in rows)


def test_legal_conversations_stay_as_they_are(spark, scratch):
    rows = [(1, 0, "system", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")]
    found = chat.rendered(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"), scratch).collect()
    found.sort(key=lambda r: r.turn)
    assert [(r.action, r.inserted, r.cost) for r in found] == [("keep", "", 0.0)] * 3
    text = "".join(r.fragment for r in found) + found[-1].closing
    assert text == "<|system|>\na\n<|end|>\n<|user|>\nb\n<|end|>\n<|assistant|>\nc\n<|end|>\n"
    none = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert chat.rendered(none, Scratch(spark, "none")).count() == 0


# ---- vectors ------------------------------------------------------------------------------------------------


def test_decode_finds_the_nearest_lattice_point():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 8)) * 2
    own = decode(x)
    twice = own * 2
    assert (twice == np.rint(twice)).all() and ((twice % 2 == twice[:, :1] % 2).all())
    assert (own.sum(axis=1) % 2 == 0).all()
    around = own[:, None, :] + ROOTS[None]
    assert (((x[:, None, :] - around) ** 2).sum(axis=2) >= ((x - own) ** 2).sum(axis=1)[:, None] - 1e-9).all()
    assert np.allclose((ROOTS**2).sum(axis=1), 2) and len({tuple(r) for r in ROOTS}) == 240


def plain_links(rows, least=0.93):
    usable = {}
    for i, (_, vector, label) in enumerate(rows):
        if label is not None and vector and all(v is not None and math.isfinite(v) for v in vector) and any(vector):
            usable[i] = np.float32(vector).astype(np.float64)
    links = defaultdict(set)
    for a, b in itertools.combinations(usable, 2):
        x, y = usable[a], usable[b]
        if rows[a][2] == rows[b][2] and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
            links[a].add(b)
            links[b].add(a)
    return links


def vectors(kind):
    rng = np.random.default_rng(2)
    rows = []
    if kind == "planted":
        for i in range(250):
            base = rng.normal(size=64)
            base /= np.linalg.norm(base)
            rows.append((5 * i, base.tolist(), i % 3))
            for k, cosine in enumerate((0.935, 0.96, 0.99)[: i % 4]):
                other = rng.normal(size=64)
                other -= (other @ base) * base
                other /= np.linalg.norm(other)
                rows.append((5 * i + 1 + k, (cosine * base + math.sqrt(1 - cosine**2) * other).tolist(), i % 3))
    else:
        v = rng.normal(size=16).tolist()
        rows = [
            (1, v, 1), (2, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [0.0] * 16, 1), (7, [], 1),
            (8, [math.nan, *v[1:]], 1), (9, [math.inf, *v[1:]], 1), (10, [None, *v[1:]], 1), (None, v, 1), (None, [1.0] * 16, 1),
            (11, [2 * x for x in v], 1), (12, v[:8], 1), (13, [-x for x in v], 1), (14, [1e-30 * x for x in v], 1), (15, [1e30 * x for x in v], 1),
        ]
    return rows


@pytest.mark.parametrize("kind", ["planted", "odd", "none"])
def test_vectors_like_all_pairs(spark, scratch, kind):
    rows = [] if kind == "none" else vectors(kind)
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<float>, label int, size int, KEPT string")
    found = near_vectors(frame, scratch).collect()
    assert len(found) == len(rows)
    links = plain_links(rows)
    expected = sorted((r[0] is None, r[0] or 0, len(links[i])) for i, r in enumerate(rows))
    ours = sorted((r.vec_id is None, r.vec_id or 0, r.n_links) for r in found)
    if kind == "planted":
        assert sum(r[2] for r in ours) >= 0.99 * sum(r[2] for r in expected) > 0
        assert all(a[2] <= b[2] for a, b in zip(ours, expected, strict=True))
    else:
        assert ours == expected
    if kind == "odd":
        ids = {r.vec_id: r.component_id for r in found if r.vec_id is not None}
        assert ids[2] == ids[11] == 1 and ids[14] == ids[15] == 1 and ids[3] == 3 and ids[4] == 4 and ids[13] == 13
        assert sorted(r.kept for r in found if r.vec_id is None) == [False, True]


def test_recall_on_the_given_vectors(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    links = plain_links(rows)
    found = {r.vec_id: r.n_links for r in QUERIES["op8_embedding"](spark, SF_DIR).collect()}
    assert sum(found.values()) >= 0.99 * sum(map(len, links.values())) and len(found) == len(rows)


def test_doubles_of_any_size_link_as_their_directions_do(spark, scratch):
    """Squares of these leave the range of doubles at either end; the angles are those of plain vectors."""
    rows = [
        (1, [1e-200, 1e-200, 0.0], 1), (2, [2e-200, 1.9e-200, 0.0], 1), (3, [1e200, 1e200, 0.0], 1), (4, [1e300, -1e300, 0.0], 1), (5, [3.0, 3.0, 0.0], 1),
        (6, [5e-324, 5e-324, 0.0], 1), (7, [0.0, 0.0, 1e308], 1), (8, [0.0, 1e-320, 1e308], 1), (9, [1e-160, 0.0, 0.0], 2), (10, [1e160, 1e159, 0.0], 2),
    ]
    found = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), scratch).collect()}
    alike = {1, 2, 3, 5, 6}
    assert found == {**{i: (4, 1) for i in alike}, 4: (0, 4), 7: (1, 7), 8: (1, 7), 9: (1, 9), 10: (1, 9)}


def test_lines_that_differ_in_digits_marks_case_or_white_space_are_one(spark, scratch):
    pairs = [
        ("Copyright 2023 Example Press. All rights reserved.", "Copyright 2024 Example Press. All rights reserved."),
        ("Please contact the editor: (see below)!", "please CONTACT the editor see below"),
        ("Page 12 of 40", "Page 13 of 40"),
        ("A line\x0bwith\x0cold\tspaces\r", "a line with old spaces"),
    ]
    docs = [(2 * i + k, line) for i, pair in enumerate(pairs) for k, line in enumerate(pair)]
    found = without_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string"), scratch).collect()
    assert {r.doc_id: r.text for r in found} == {i: line if i % 2 == 0 else "" for i, line in docs}

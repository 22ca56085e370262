"""Exact and SimHash near-dedup, and components, against plain Python."""

import random
from collections import defaultdict
from hashlib import sha256

import pytest
import xxhash
from llm_cases import SF_DIR, no_docs, odd_docs, real_docs
from pyspark.sql import functions as F

from lodestone.llm.components import connected_components
from lodestone.llm.exact_dedup import exact_groups, folded, keep_exact
from lodestone.llm.queries import ORACLE_SQL, QUERIES
from lodestone.llm.scratch import Scratch
from lodestone.llm.simhash import _masks, close_fingerprints, fingerprint, keep_first, near_duplicates
from oracle.compare import connect, differences


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_duckdb(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE_SQL[name]) == []


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, scratch, shape):
    random.seed(5)
    links = {
        "chain": [(i, i + 1) for i in range(200)],
        "star": [(0, i) for i in range(1, 300)],
        "random": [(random.randrange(400), random.randrange(400)) for _ in range(300)],
        "none": [],
    }[shape]
    found = connected_components(spark.createDataFrame(links + links[:3], "a long, b long"), scratch).collect()
    real = [(a, b) for a, b in links if a != b]
    expected = defaultdict(set)
    for node, root in roots({n for link in real for n in link}, real).items():
        expected[root].add(node)
    ours = defaultdict(set)
    for row in found:
        ours[row.root].add(row.node)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, expected.values()))


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_groups_of_odd_rows(spark, scratch, keep):
    docs = odd_docs(spark)
    rows = exact_groups(docs, scratch, keep).collect()
    classes = defaultdict(list)
    for r in docs.collect():
        classes[fold(r.text)].append(r.doc_id)
    pick = min if keep == "smallest" else max
    expected = []
    for text, ids in classes.items():
        stays = pick([i for i in ids if i is not None], default=None)
        seen = set()
        for i in ids:
            expected.append((i, stays, len(ids), i == stays and i not in seen, sha256(text.encode()).hexdigest()))
            seen.add(i)
    found = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_texts_that_share_a_hash_are_told_apart(spark, scratch):
    docs = odd_docs(spark)
    weak = exact_groups(docs, scratch, "largest", content_hash=lambda t: F.length(t) % 2).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    strong = exact_groups(docs, Scratch(spark, "strong"), "largest").select(*weak.columns)
    assert sorted(map(str, weak.collect())) == sorted(map(str, strong.collect()))
    assert docs.select(folded(F.col("text"))).count() == weak.count()


def test_keep_exact_keeps_columns_and_one_of_each(spark, scratch):
    docs = odd_docs(spark)
    kept = keep_exact(docs, scratch, "largest")
    assert kept.schema == docs.schema
    rows = kept.collect()
    texts = [fold(r.text) for r in rows]
    assert len(texts) == len(set(texts)) == len({fold(r.text) for r in docs.collect()})
    assert [r.doc_id for r in rows if fold(r.text).startswith("one two")] == [5]
    assert keep_exact(no_docs(spark), Scratch(spark, "none")).count() == 0


def plain_fingerprint(text, shingle):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprint_is_the_majority_of_shingle_hashes():
    for text in (None, "", " ", "a", "a b", "A b c", "a b c d", "x\x0by\x1cz w", "é É ß", "r s t " * 900, "q " * 70_000):
        assert fingerprint(text) % (1 << 64) == plain_fingerprint(text, 3), text


def test_masks_catch_every_pair_within_the_distance():
    masks = [m % (1 << 64) for m in _masks(2)]
    for i in range(64):
        for j in range(i + 1):
            different = 1 << i | 1 << j
            assert any(different & m == 0 for m in masks)


def test_close_fingerprints_are_all_found(spark):
    random.seed(6)
    prints = {random.getrandbits(64) for _ in range(50)}
    prints |= {p ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)) for p in prints for _ in range(4)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = close_fingerprints(spark.createDataFrame([(p,) for p in signed], "fingerprint long")).distinct().collect()
    expected = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2}
    assert {(r.a, r.b) for r in found} == expected


@pytest.mark.parametrize("make", [odd_docs, real_docs, no_docs])
def test_near_duplicates_like_all_pairs(spark, scratch, make):
    docs = make(spark)
    texts = [(r.doc_id, fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
    prints = sorted({p for _, p in texts})
    links = [(a, b) for a in prints for b in prints if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2]
    root = roots(prints, links)
    smallest = {}
    for doc_id, p in texts:
        if doc_id is not None:
            smallest[root[p]] = min(doc_id, smallest.get(root[p], doc_id))
    expected = sorted(((d, p, smallest.get(root[p])) for d, p in texts), key=str)
    found = near_duplicates(docs, scratch).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=str) == expected


def test_keep_first_keeps_one_document_of_each_group(spark, scratch):
    docs = odd_docs(spark)
    kept = keep_first(docs, scratch)
    assert kept.schema == docs.schema
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and 3 not in ids and 5 not in ids and 7 in ids and 8 not in ids

"""The corpus pipeline: each stage against plain Python on what the stage before it kept."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_cases import SF_DIR, odd_docs
from tokenizers import Tokenizer

import corpus_pipeline
from lodestone.llm.packing import word_bpe
from lodestone.llm.scratch import Scratch, documents
from lodestone.llm.simhash import fingerprint
from lodestone.llm.toxicity import learn_model


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def stages(spark):
    scratch, docs, out = Scratch(spark, "test"), documents(spark, SF_DIR), []
    for name, stage in corpus_pipeline.STAGES:
        out.append(docs.collect())
        schema = docs.schema
        docs = scratch.save(stage(spark, docs, SF_DIR), name)
        if name != "packing":
            assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in schema]
    return [*out, docs.collect()]


def test_toxic_documents_go_and_others_stay(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = learn_model(documents(spark, SF_DIR), labels, Scratch(spark, "model"))
    assert sorted(r.doc_id for r in stages[1]) == sorted(r.doc_id for r in stages[0] if model.score(r.text) < 0.5)
    toxic = {r.doc_id for r in labels.collect() if r.toxic == 0}
    assert toxic <= {r.doc_id for r in stages[1]}


def test_of_equal_texts_the_largest_id_stays(stages):
    groups = defaultdict(list)
    for r in stages[1]:
        groups[fold(r.text)].append(r.doc_id)
    assert sorted(r.doc_id for r in stages[2]) == sorted(max(ids) for ids in groups.values())


def test_of_near_duplicates_the_smallest_id_stays(stages):
    prints = {r.doc_id: fingerprint(r.text) for r in stages[2]}
    group = {d: d for d in prints}

    def find(d):
        while group[d] != d:
            d = group[d]
        return d

    for a in prints:
        for b in prints:
            if a < b and ((prints[a] ^ prints[b]) % (1 << 64)).bit_count() <= 2 and find(a) != find(b):
                low, high = sorted((find(a), find(b)))
                group[high] = low
    assert sorted(r.doc_id for r in stages[3]) == sorted({find(d) for d in prints})


def test_the_mix_has_half_more_words_and_whole_documents(stages):
    words = lambda rows: sum(len((r.text or "").encode().split()) for r in rows)
    assert words(stages[4]) == pytest.approx(1.5 * words(stages[3]), rel=0.02)
    before = {r.doc_id: r.text for r in stages[3]}
    cut = [r for r in stages[4] if r.text != before[r.doc_id]]
    assert all(before[r.doc_id].strip().startswith(r.text.strip()) for r in cut) and len(cut) <= 20
    assert max(sum(1 for r in stages[4] if r.doc_id == d) for d in before) <= 2


def test_packing_holds_every_id_of_the_mix(spark, stages):
    plain = Tokenizer.from_file(word_bpe())
    ids = defaultdict(list)
    for r in stages[4]:
        ids[r.doc_id].append(np.array([*plain.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4"))
    pieces = stages[5]
    assert sum(r.length for r in pieces) == sum(len(i) for own in ids.values() for i in own)
    for r in pieces:
        own = [i for i in ids[r.doc_id] if len(i) == r.doc_tokens]
        assert r.ids_crc32 in {zlib.crc32(i[r.start : r.start + r.length].tobytes()) for i in own}
    whole = {r.sequence_id: r.sequence_length for r in pieces}
    assert all(n == 4096 or n & (n - 1) == 0 for n in whole.values())


def test_every_stage_takes_odd_rows_and_no_rows(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0), (4, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (odd_docs(spark), odd_docs(spark).limit(0)):
        docs = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.schema.names == rows.schema.names
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert (pieces.count() > 0) is (rows.count() > 0)


def test_run_gives_what_the_stages_give(spark, stages):
    rows = corpus_pipeline.run(spark, SF_DIR)
    digest = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    key = lambda rows: sum(r.length for r in rows)
    found = rows.collect()
    assert key(found) == key(stages[5]) and {d.doc_id for d in found} == {d.doc_id for d in stages[5]} and digest(found[0])

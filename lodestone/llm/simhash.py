"""SimHash near-duplicates: fingerprints of word shingles, joined on pigeonhole blocks and verified by Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.components import connected_components
from lodestone.llm.scratch import Scratch, documents

SHINGLE, DISTANCE, SEED = 3, 2, 42
BITS = 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The text's SimHash as a signed 64-bit number; 0 if it has no words."""
    # Of bytes, lower() changes A-Z and split() cuts at \x20 and \x09-\x0D only.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: max(0, len(words) - shingle)]]
    digest = xxhash.xxh64_digest
    ones, total = np.zeros(BITS, np.int64), len(starts)
    for at in range(0, total, 1 << 16):
        part = zip(starts[at : at + (1 << 16)], ends[min(shingle, len(words)) - 1 + at :], strict=False)
        hashes = np.frombuffer(b"".join([digest(joined[s : e - 1], SEED) for s, e in part]), np.uint8)
        ones += np.unpackbits(hashes.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint) of each row of `docs`, from its whole text."""

    @F.pandas_udf("long")
    def of_texts(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, shingle) for t in batch], dtype="int64")

    return docs.select("doc_id", of_texts("text").alias("fingerprint"))


def _masks(distance: int) -> list[int]:
    """Masks that each keep some blocks of bits. Two fingerprints that differ in at most `distance` bits are equal under
    one mask at least: twice as many blocks as needed, and a mask for every choice of `distance` blocks to leave out.
    With 6 blocks for 2 bits, a mask keeps 42 bits or more, so chance meetings stay rare for billions of documents."""
    blocks = distance + 4
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    masks = [sum(kept) for kept in combinations(masks, blocks - distance)]
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]


def close_fingerprints(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): all pairs a < b of the distinct `fingerprint`s that differ in at most `distance` bits, perhaps repeated."""
    tagged = [F.struct(F.lit(i).alias("mask"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("block")) for i, m in enumerate(_masks(distance))]
    blocks = prints.select("fingerprint", F.explode(F.array(*tagged)).alias("at")).select("fingerprint", "at.*")
    left = blocks.select("mask", "block", F.col("fingerprint").alias("a"))
    right = blocks.select("mask", "block", F.col("fingerprint").alias("b"))
    a, b = F.col("a"), F.col("b")
    near = (a < b) & (F.bit_count(a.bitwiseXOR(b)) <= distance)
    on = (left["mask"] == right["mask"]) & (left["block"] == right["block"])
    return left.join(right, on & near).select("a", "b")


def near_duplicates(docs: DataFrame, scratch: Scratch, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id), a row for each row of `docs`.

    Fingerprints link at `distance` or fewer differing bits; component_id is the smallest doc_id reachable, itself
    included. Copies meet as one fingerprint first, so a group of copies of any size costs one row in the block join.
    Null, empty and wordless texts have fingerprint 0 and link like others. A null doc_id counts only where a component
    has no other, whose component_id is then null. Repeated rows stay rows. No rows give none. Other columns are not read.
    """
    rows = scratch.save(fingerprints(docs, shingle), "fingerprints")
    distinct = scratch.save(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct")
    parts = connected_components(close_fingerprints(distinct, distance), scratch)
    linked = distinct.join(parts, distinct["fingerprint"] == parts["node"]).select("fingerprint", "first_id", "root")
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = linked.join(smallest, "root").select(F.col("fingerprint").alias("linked"), "component_id")
    classes = distinct.join(linked, distinct["fingerprint"] == linked["linked"], "left").select(
        F.col("fingerprint").alias("print"), F.coalesce("component_id", "first_id").alias("component_id")
    )
    classes = scratch.save(classes, "classes")
    return rows.join(classes, rows["fingerprint"] == classes["print"]).select("doc_id", "fingerprint", "component_id")


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def keep_first(docs: DataFrame, scratch: Scratch, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of `docs` that stay: of each component the document with the smallest doc_id. Rows that share a doc_id
    are one document. In a component without any doc_id all rows stay, as none can be named."""
    groups = near_duplicates(docs, scratch, shingle, distance)
    stay = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("stay_id")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("own_id"))
    return rows.join(stay, F.col("own_id").eqNullSafe(F.col("stay_id")), "left_semi").select("row.*")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(documents(spark, sf_dir), Scratch(spark, "simhash"))
    return groups.select("doc_id", hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")

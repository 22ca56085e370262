"""Exact deduplication by a 128-bit content hash, with the bytes compared inside each group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.scratch import Scratch, documents

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A table of at most so many group hashes (16 bytes and a little overhead each) is sent to every task.
BROADCAST_GROUPS = 250_000


def folded(text: Column) -> Column:
    """The text with A-Z in lower case; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_groups(
    docs: DataFrame,
    scratch: Scratch,
    keep: str = "smallest",
    normal: Callable[[Column], Column] = folded,
    content_hash: Callable[[Column], Column] = md5_128,
) -> DataFrame:
    """(doc_id, content_hash, text_sha256, copy, keep_id, group_size, kept), a row for each row of `docs`.

    Rows are grouped by `content_hash` of the normalised text. The texts of groups with several rows are then compared
    whole: they are grouped by hash and text, where copies meet as one row before the shuffle, so that no task ever holds a
    group. If different texts share a hash, these groups are split by text. `keep` says which doc_id stays, "smallest"
    or "largest". Null texts are what `normal` makes of them (empty); a null doc_id stays only where its group has no
    other; of repeated rows with the kept doc_id only the one with copy = 1 is kept. Other columns are not read.
    An empty table gives no rows.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    text = normal(F.col("text"))
    rows = scratch.save(
        docs.select("doc_id", text.alias("text")).select(
            "doc_id", content_hash(F.col("text")).alias("content_hash"), F.sha2("text", 256).alias("text_sha256")
        ),
        "hashes",
    )
    counted = rows.groupBy("content_hash").agg(pick("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = scratch.save(counted, "groups")
    shared = groups.where(F.col("group_size") > 1).select("content_hash")
    if shared.count() <= BROADCAST_GROUPS:
        shared = F.broadcast(shared)
    texts = docs.select("doc_id", text.alias("text")).select("doc_id", "text", content_hash(F.col("text")).alias("content_hash"))
    compared = texts.join(shared, "content_hash", "left_semi").groupBy("content_hash", "text").agg(F.count("*").alias("n"))
    texts_of = compared.groupBy("content_hash").agg(F.count("*").alias("texts"))
    collisions = scratch.save(texts_of.where("texts > 1").select("content_hash"), "collisions")
    copies = rows.groupBy("content_hash", "text_sha256", "doc_id").agg(F.count("*").alias("copies"))
    found = copies.join(groups, "content_hash")
    if not collisions.isEmpty():
        found = found.join(collisions, "content_hash", "left_anti").unionByName(_split(texts, collisions, pick))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "doc_id", "content_hash", "text_sha256", "copy", "copies", "keep_id", "group_size", kept.alias("kept")
    )


def _split(texts: DataFrame, collisions: DataFrame, pick: Callable[[str], Column]) -> DataFrame:
    """Groups of which the texts differ, by hash and whole text."""
    texts = texts.join(collisions, "content_hash", "left_semi")
    classes = texts.groupBy("content_hash", "text").agg(pick("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    rows = texts.groupBy("content_hash", "text", "doc_id").agg(F.count("*").alias("copies"))
    return rows.join(classes, ["content_hash", "text"]).select(
        "content_hash", F.sha2("text", 256).alias("text_sha256"), "doc_id", "copies", "keep_id", "group_size"
    )


def keep_exact(docs: DataFrame, scratch: Scratch, keep: str = "smallest") -> DataFrame:
    """The rows of `docs` that stay, with all their columns. Of repeated rows with the same doc_id and text, one."""
    stay = exact_groups(docs, scratch, keep).where("kept").select(
        F.col("text_sha256").alias("sha"), F.col("doc_id").alias("keep_id"), "copies"
    )
    whole = F.struct(*docs.columns).alias("row")
    rows = docs.select(whole, F.sha2(folded(F.col("text")), 256).alias("own_sha"), F.col("doc_id").alias("own_id"))
    same = (F.col("own_sha") == F.col("sha")) & F.col("own_id").eqNullSafe(F.col("keep_id"))
    stay = rows.join(stay, same)
    repeated = stay.where("copies > 1").dropDuplicates(["sha", "keep_id"])
    return stay.where("copies = 1").unionByName(repeated).select("row.*")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(documents(spark, sf_dir), Scratch(spark, "exact-dedup"), keep="largest")
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

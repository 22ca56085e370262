"""Difference between two entity snapshots, without ever mistaking an empty delivery for a mass deletion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.entities import entity_json

INSERT, UPDATE, UNCHANGED, ARCHIVE = "insert", "update", "unchanged", "archive"
ENTITY_KEY = ("connection_qn", "typeName", "qualifiedName")


class EmptySnapshotError(RuntimeError):
    """The new snapshot holds nothing although the old one does."""


def refuse_empty(new: DataFrame, old: DataFrame) -> None:
    """Raise when the whole new side is empty and the old one is not."""
    if new.isEmpty() and not old.isEmpty():
        raise EmptySnapshotError("the new snapshot is empty; nothing is archived")


def fingerprints(entities: DataFrame) -> DataFrame:
    """ENTITY_KEY and two hashes of the content, a row for each entity."""
    # Hashes of the JSON text, not of the struct: hashing a struct skips NULLs and would confuse attributes.
    content = entity_json(entities)
    return entities.select(
        "connection_qn",
        "typeName",
        F.col("attributes.qualifiedName").alias("qualifiedName"),
        F.xxhash64(content).alias("h1"),
        F.xxhash64(F.lit("second"), content).alias("h2"),
    )


def _change(has_old: Column, has_new: Column, same: Column) -> Column:
    return (
        F.when(has_new & ~has_old, INSERT).when(has_new & same, UNCHANGED).when(has_new, UPDATE).otherwise(ARCHIVE)
    )


def _by_key(both: DataFrame) -> DataFrame:
    contents = both.groupBy(*ENTITY_KEY, "h1", "h2").agg(
        F.bool_or(~F.col("is_new")).alias("in_old"), F.bool_or("is_new").alias("in_new")
    )
    return contents.groupBy(*ENTITY_KEY).agg(
        F.bool_or("in_old").alias("has_old"),
        F.bool_or("in_new").alias("has_new"),
        F.bool_and(F.col("in_old") & F.col("in_new")).alias("same"),
    )


def compared(both: DataFrame) -> DataFrame:
    """One row per entity key of `both` (`fingerprints` of two snapshots, with is_new) with its change.

    Both sides are aggregated together instead of outer-joined: contents first (copies collapse on the map side), then keys, so a
    qualified name that many entities share never pairs them up. Such a name is unchanged when both sides hold the same
    set of contents.
    """
    return _by_key(both).select(*ENTITY_KEY, _change(F.col("has_old"), F.col("has_new"), F.col("same")).alias("change"))


def snapshot_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per entity key with its change: insert, update, unchanged or archive.

    Only connections of which the new snapshot delivered anything take part; what the others had stays as it is
    (see `undelivered_connections`).
    """
    sides = [fingerprints(df).withColumn("is_new", F.lit(is_new)) for df, is_new in ((old, False), (new, True))]
    keys = _by_key(sides[0].unionByName(sides[1]))
    # From the keys, which are there already: the new snapshot is planned and read once. Connection and type, not connection
    # alone: a semi join does not mind the repeats, and this side is then shuffled for the join itself, which lets Spark
    # split a hot connection.
    delivered = keys.where("has_new").select("connection_qn", "typeName").distinct().select("connection_qn")
    return keys.join(delivered, "connection_qn", "left_semi").select(
        *ENTITY_KEY, _change(F.col("has_old"), F.col("has_new"), F.col("same")).alias("change")
    )


def undelivered_connections(old: DataFrame, new: DataFrame) -> DataFrame:
    """Connections the old snapshot has and the new one has nothing of."""
    return old.select("connection_qn").distinct().join(
        new.select("connection_qn").distinct(), "connection_qn", "left_anti"
    )


def incremental_changes(last: DataFrame, new: DataFrame) -> DataFrame:
    """Only what has to be published after a run: the diff without unchanged entities."""
    return snapshot_diff(last, new).where(F.col("change").isin(INSERT, UPDATE, ARCHIVE))


def changed_entities(last: DataFrame, new: DataFrame) -> DataFrame:
    """The new snapshot's entities that were inserted or updated, complete, ready to be delivered again."""
    changed = snapshot_diff(last, new).where(F.col("change").isin(INSERT, UPDATE)).select(*ENTITY_KEY)
    keyed = new.withColumn("qualifiedName", F.col("attributes.qualifiedName"))
    return keyed.join(changed, list(ENTITY_KEY), "left_semi").select(*new.columns)

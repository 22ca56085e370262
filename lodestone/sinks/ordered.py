"""Tables delivered in one order over all their files, and the proof of it from what was delivered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.sinks.commits import CommitLog

BOUNDS = "_bounds"


def _files(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows with the file each is in and its place there."""
    place = F.col("_metadata")
    return spark.read.parquet(path).select("*", place["file_name"].alias("file"), place["row_index"].alias("place"))


def write_ordered(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Write `df` below `path`, a new folder, ordered by `order` (nulls first) over all files by name, with a list of the files:
    rows, first and last key of each.

    Rows are dealt over tasks by ranges of the key, so every task sorts its own range and no task sees all rows. Rows of one
    key go to one task: choose an order that tells most rows apart.
    """
    spark = df.sparkSession
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    key = F.struct(*order)
    bounds = _files(spark, path).groupBy("file").agg(F.count("*").alias("rows"), F.min(key).alias("first"), F.max(key).alias("last"))
    bounds.write.parquet(f"{path}/{BOUNDS}")
    CommitLog(spark, f"{path}/_log").commit(1, {"order": list(order)})


def file_bounds(spark: SparkSession, path: str) -> DataFrame:
    """A row for each file: file, rows, first, last, and before: the rows of all files before it."""
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file.
    return spark.read.parquet(f"{path}/{BOUNDS}").withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows with position, from 1, over all files. Only the list of files is read twice; no row is sorted or moved."""
    rows, before = _files(spark, path), file_bounds(spark, path).select("file", "before")
    names = [c for c in rows.columns if c not in ("file", "place")]
    return rows.join(before, "file").select(*names, (F.col("before") + F.col("place") + 1).alias("position"))


def inversions(spark: SparkSession, path: str, order: Sequence[str]) -> DataFrame:
    """(file, place, kind): rows whose key is below that of the row before, `inside` a file or at its `border` with the file
    before; and files whose rows are not those of the list (`rows`)."""
    key = F.struct(*order)
    rows = _files(spark, path)
    in_file = Window.partitionBy("file").orderBy("place")
    inside = rows.withColumn("earlier", F.lag(key).over(in_file)).where(F.col("earlier") > key).select("file", "place", F.lit("inside").alias("kind"))
    bounds = file_bounds(spark, path)
    by_name = Window.orderBy("file")
    border = bounds.withColumn("earlier", F.lag("last").over(by_name)).where("earlier > first").select("file", F.lit(0).cast("bigint").alias("place"), F.lit("border").alias("kind"))
    now = rows.groupBy("file").agg(F.count("*").alias("rows"), F.min(key).alias("first"), F.max(key).alias("last"))
    told = bounds.select("file", F.struct("rows", "first", "last").alias("told"))
    met = now.select("file", F.struct("rows", "first", "last").alias("found")).join(told, "file", "full_outer")
    other = met.where(~F.col("told").eqNullSafe(F.col("found"))).select("file", F.lit(None).cast("bigint").alias("place"), F.lit("rows").alias("kind"))
    return inside.unionByName(border).unionByName(other)

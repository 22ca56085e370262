"""Tables in one order over their files."""

import random

from pyspark.sql import functions as F

from lodestone.operators import inventory as I
from lodestone.sinks.ordered import file_bounds, inversions, read_ordered, write_ordered
from lodestone.sources.derived import DerivedCatalog
from conftest import SF_DIR

ORDER = ("table_schema", "table_name", "ordinal_position")


def test_columns_are_in_order_over_files(spark, conf, tmp_path):
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="7")
    df = I.column_inventory(DerivedCatalog(spark, SF_DIR, 3)).select("connection_qn", *ORDER)
    path, order = str(tmp_path / "c"), ("connection_qn", *ORDER)
    write_ordered(df, path, order)
    assert file_bounds(spark, path).count() > 3
    rows = read_ordered(spark, path).collect()
    found = [tuple(r)[:-1] for r in sorted(rows, key=lambda r: r.position)]
    assert found == sorted(found) and [r.position for r in sorted(rows, key=lambda r: r.position)] == list(range(1, len(rows) + 1))
    assert len(rows) == df.count() and inversions(spark, path, order).isEmpty()


def test_nulls_come_first_and_nothing_is_ordered_too(spark, frame, tmp_path):
    df = frame("a string, b int", ("x", 1), (None, 2), ("x", None), (None, None))
    write_ordered(df, str(tmp_path / "n"), ("a", "b"))
    rows = read_ordered(spark, str(tmp_path / "n")).orderBy("position").collect()
    assert [(r.a, r.b) for r in rows] == [(None, None), (None, 2), ("x", None), ("x", 1)]
    write_ordered(df.limit(0), str(tmp_path / "e"), ("a", "b"))
    assert read_ordered(spark, str(tmp_path / "e")).isEmpty() and inversions(spark, str(tmp_path / "e"), ("a", "b")).isEmpty()


def test_every_inversion_is_told(spark, tmp_path):
    values = [i for i in range(100)]
    random.Random(1).shuffle(values)
    path = str(tmp_path / "t")
    # Files as a writer without ranges leaves them; then a proper list of them.
    write_ordered(spark.range(1), str(tmp_path / "x"), ("id",))
    spark.createDataFrame([(v,) for v in values], "id long").repartition(4).write.parquet(path)
    files = spark.read.parquet(path).select("id", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place")).collect()
    by_file = {}
    for r in sorted(files, key=lambda r: (r.file, r.place)):
        by_file.setdefault(r.file, []).append(r.id)
    key = F.struct("id")
    listed = spark.read.parquet(path).select("id", F.col("_metadata.file_name").alias("file"))
    listed = listed.groupBy("file").agg(F.count("*").alias("rows"), F.min(key).alias("first"), F.max(key).alias("last"))
    listed.withColumn("rows", F.col("rows") + F.when(F.col("file") == min(by_file), 1).otherwise(0)).write.parquet(f"{path}/_bounds")
    expected = {(f, i, "inside") for f, ids in by_file.items() for i in range(1, len(ids)) if ids[i] < ids[i - 1]}
    names = sorted(by_file)
    expected |= {(b, 0, "border") for a, b in zip(names, names[1:], strict=False) if max(by_file[a]) > min(by_file[b])}
    expected.add((names[0], None, "rows"))
    assert {tuple(r) for r in inversions(spark, path, ("id",)).collect()} == expected

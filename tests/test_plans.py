"""Plans: what is scanned, what is shuffled, and that hot keys are split."""

import re

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry
from lodestone.operators import inventory as I
from lodestone.operators.constraints import constraint_roles
from lodestone.operators.diff import snapshot_diff
from lodestone.operators.quality import orphan_columns
from lodestone.plans.extraction import EntityStreams
from lodestone.session import RUNTIME_CONF
from lodestone.sources.catalog import catalog_from, read_parquet_catalog, write_parquet_catalog
from lodestone.sources.derived import DerivedCatalog
from pyspark.sql import functions as F


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df._jdf.queryExecution().executedPlan().execute().count()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("catalog"))
    write_parquet_catalog(DerivedCatalog(spark, SF_DIR, 3), root)
    return read_parquet_catalog(spark, root)


@pytest.fixture
def shuffled(conf):
    """Plan as for sides too large to broadcast."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )


def test_no_query_leaves_the_jvm_crosses_tables_or_forces_a_broadcast(spark):
    for name, query in entry.catalog_queries().items():
        df = query(spark, SF_DIR)
        assert not re.search("Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", plan(df)), name
        text = df._jdf.queryExecution().logical().toString()
        assert "ResolvedHint" not in text and "UnresolvedHint" not in text, name


def test_system_schemas_and_kept_kinds_reach_the_scan(stored):
    text = plan(I.accessible_tables(stored))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "In(table_type" in pushed and "Not(In(table_schema" in pushed


def test_count_reads_two_columns(stored):
    text = I.schema_inventory(stored)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any(set(re.findall(r"(\w+):", s)) == {"connection_qn", "table_schema", "table_type"} for s in schemas)


def test_constraint_relations_are_scanned_once(stored, shuffled):
    text = plan(I.column_inventory(stored))
    assert len(re.findall(r"FileScan parquet .*key_column_usage", text)) == 1
    assert len(re.findall(r"FileScan parquet .*table_constraints", text)) == 1
    assert len(re.findall(r"FileScan parquet", text)) == 4


def test_column_rows_are_shuffled_once_and_key_relations_stay_narrow(stored, shuffled):
    left = plan(I.column_inventory(stored)).split("FileScan parquet")[0]
    assert left.count("Exchange hashpartitioning") == 1 and left.count("SortMergeJoin") == 2


def test_table_rows_are_shuffled_once(stored, shuffled):
    left = plan(I.table_inventory(stored)).split("FileScan parquet")[0]
    assert left.count("Exchange hashpartitioning") == 1 and left.count("SortMergeJoin") == 3


@pytest.fixture
def hot(spark, stored, conf, shuffled):
    """A third of all columns in one table, and as many exact copies of one column."""
    conf(
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="16",
    )
    table = stored.tables.where("table_type = 'BASE TABLE'").orderBy("connection_qn", "table_name").limit(1)
    one = stored.columns.limit(1).drop("connection_qn", "table_schema", "table_name", "column_name")
    place = table.select("connection_qn", "table_schema", "table_name")
    many = spark.range(0, 12_000, 1, 4)
    wide = many.select(F.concat(F.lit("x"), F.col("id").cast("string")).alias("column_name"))
    copies = many.select(F.lit("same").alias("column_name"))
    rows = place.crossJoin(one).crossJoin(wide.unionByName(copies)).select(*stored.columns.columns)
    columns = stored.columns.repartition(4).unionByName(rows.repartition(8))
    return catalog_from({**vars(stored), "columns": columns})


def test_a_hot_table_is_split_and_no_column_is_lost(hot, stored):
    df = I.column_inventory(hot)
    assert "skew=true" in final_plan(df)
    assert df.count() == I.column_inventory(stored).count() + 12_000 + 1


def test_a_hot_table_is_split_in_the_orphan_check(hot):
    catalog = catalog_from({**vars(hot), "tables": hot.tables.where("table_type = 'VIEW'")})
    df = orphan_columns(catalog)
    assert "skew=true" in final_plan(df)
    assert df.count() > 12_000


def test_a_hot_connection_is_split_in_the_snapshot_diff(spark, hot):
    """Two thirds of all entities in one connection; the check of delivered connections joins on it."""
    streams = EntityStreams(hot)
    old, new = streams["column"], streams["column"].where("attributes.isNullable")
    df = snapshot_diff(old, new)
    join = next(line for line in final_plan(df).splitlines() if "Join" in line)
    assert "LeftSemi" in join and "skew=true" in join
    counts = {r.change: r["count"] for r in df.groupBy("change").count().collect()}
    assert sum(counts.values()) == old.count() and counts["unchanged"] == new.count()


def test_a_hot_constraint_is_split(spark, stored, hot):
    """A third of all key usage in one constraint."""
    one = stored.table_constraints.where("constraint_type = 'PRIMARY KEY'").limit(1).drop("constraint_type")
    many = spark.range(0, 12_000, 1, 8).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("column_name"))
    rows = one.crossJoin(many).select(*stored.key_column_usage.columns).repartition(8)
    usage = stored.key_column_usage.repartition(4).unionByName(rows)
    df = constraint_roles(catalog_from({**vars(stored), "key_column_usage": usage}))
    assert "skew=true" in final_plan(df)
    assert df.count() == constraint_roles(stored).count() + 12_000


def test_repeated_relations_do_not_multiply(stored):
    twice = {name: df.unionByName(df).unionByName(df) for name, df in vars(stored).items() if name not in ("tables", "columns")}
    noisy = catalog_from({**vars(stored), **twice})
    assert I.column_inventory(noisy).count() == I.column_inventory(stored).count()
    assert I.table_inventory(noisy).count() == I.table_inventory(stored).count()
    assert constraint_roles(noisy).exceptAll(constraint_roles(stored)).isEmpty()


def test_partition_lists_gather_each_name_once(spark, make_catalog):
    """Many repeats of few names: counted before they are gathered."""
    rows = spark.range(60_000).select(
        F.lit("c").alias("connection_qn"), F.lit("s").alias("table_schema"), F.lit("t").alias("table_name"),
        F.lit("RANGE").alias("partition_method"), F.concat(F.lit("p"), (F.col("id") % 3).cast("string")).alias("partition_name"),
    )
    row = I.partition_summary(catalog_from({**vars(make_catalog()), "partitions": rows})).first()
    assert row.partition_count == 60_000
    assert row.partitions == ",".join(["p0"] * 20_000 + ["p1"] * 20_000 + ["p2"] * 20_000)


def test_session_settings_are_applied(spark):
    assert {k: spark.conf.get(k) for k in RUNTIME_CONF} == RUNTIME_CONF

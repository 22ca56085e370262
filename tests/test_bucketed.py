"""A catalog stored by table: what is read back, and that nothing is moved to join it."""

import re

import pytest
from conftest import SF_DIR

from lodestone.operators import inventory as I
from lodestone.operators.constraints import constraint_roles
from lodestone.operators.filters import CatalogFilter
from lodestone.plans.extraction import EntityStreams
from lodestone.sources import bucketed as B
from lodestone.sources.catalog import RELATION_SCHEMAS, read_parquet_catalog
from lodestone.sources.derived import DerivedCatalog


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("it's stored") / "catalog")
    B.write_bucketed_catalog(spark, DerivedCatalog(spark, SF_DIR, 3), root, buckets=8)
    return root, read_parquet_catalog(spark, root)


def final_plan(df):
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    return plan.toString().split("== Initial Plan ==")[0]


def test_all_relations_come_back(spark, stored):
    _, catalog = stored
    derived = DerivedCatalog(spark, SF_DIR, 3)
    for name, schema in RELATION_SCHEMAS.items():
        df, was = getattr(catalog, name), getattr(derived, name)
        assert df.dtypes == was.dtypes and df.schema.fieldNames() == schema.fieldNames()
        assert df.exceptAll(was).isEmpty() and was.exceptAll(df).isEmpty()


@pytest.mark.parametrize(
    "build", [I.column_inventory, I.table_inventory, I.partition_summary, constraint_roles, lambda c: EntityStreams(c)["column"]],
    ids=["columns", "tables", "partitions", "roles", "entities"],
)
def test_nothing_is_moved(spark, stored, conf, build):
    """With sides too large to broadcast, the extracts over the stored catalog have no exchange at all."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="8")
    text = final_plan(build(stored[1]))
    assert not re.search("Exchange|BroadcastHashJoin", text), text
    assert "Bucketed: true" in text or "SelectedBucketsCount: 8" in text


def test_small_sides_are_broadcast_and_the_columns_stay(spark, stored):
    text = final_plan(I.column_inventory(stored[1], CatalogFilter(include="nation_1", exclude_table="_TMP$")))
    # Every shuffle is of a side that is small; none stands above the scan of the columns.
    for block in text.split("Exchange hashpartitioning")[1:]:
        assert "ordinal_position" not in block.split("FileScan")[1].split("PartitionFilters")[0]


def test_filters_on_connections_reach_the_files(spark, stored):
    df = stored[1].columns.where("connection_qn = 'default/mysql/2'")
    assert "EqualTo(connection_qn,default/mysql/2)" in final_plan(df)


def test_a_catalog_that_was_not_finished_is_none(spark, tmp_path, monkeypatch):
    broken = DerivedCatalog(spark, SF_DIR)
    monkeypatch.setattr(type(broken), "routines", property(lambda self: 1 / 0))
    root = str(tmp_path / "c")
    with pytest.raises(ZeroDivisionError):
        B.write_bucketed_catalog(spark, broken, root, buckets=2)
    assert not B.is_bucketed(spark, root)
    with pytest.raises(ValueError, match="no whole catalog"):
        B.read_bucketed_catalog(spark, root)


def test_buckets_grow_with_the_columns(spark, make_catalog, tmp_path, conf, monkeypatch):
    conf(spark__sql__shuffle__partitions="2")
    monkeypatch.setattr(B, "BUCKET_ROWS", 100)
    tables = [{"table_schema": "s", "table_name": f"t{n}"} for n in range(50)]
    columns = [{**t, "column_name": f"c{i}"} for t in tables for i in range(21)]
    catalog = make_catalog(tables=tables, columns=columns)
    B.write_bucketed_catalog(spark, catalog, str(tmp_path / "large"))
    B.write_bucketed_catalog(spark, make_catalog(tables=tables), str(tmp_path / "small"))
    assert [B._layout(spark, str(tmp_path / name)).latest()[1]["buckets"] for name in ("large", "small")] == [11, 2]
    again = read_parquet_catalog(spark, str(tmp_path / "large"))
    assert again.columns.exceptAll(catalog.columns).isEmpty() and again.columns.count() == 1_050


def test_rows_are_moved_before_they_are_made(spark):
    derived = DerivedCatalog(spark, SF_DIR, 3)
    for name in ("tables", "columns"):
        moved = derived.dealt(name, lambda rows: rows.repartition(8, "connection_qn"))
        text = moved._jdf.queryExecution().optimizedPlan().toString()
        assert "def AS table_catalog" in text.split("RepartitionByExpression")[0], text
        was = getattr(derived, name)
        assert moved.schema == was.schema and moved.exceptAll(was).isEmpty() and was.exceptAll(moved).isEmpty()


def test_constraints_are_made_of_the_stored_key_columns(spark, tmp_path):
    derived = DerivedCatalog(spark, SF_DIR)
    B.write_bucketed_catalog(spark, derived, str(tmp_path / "c"), buckets=2)
    assert all("/key_column_usage/" in file or "/table_constraints/" in file for file in derived.table_constraints.inputFiles())
    assert not derived.key_column_usage.isEmpty() and "lineitem" not in "".join(derived.key_column_usage.inputFiles())


def test_stored_rows_are_not_sorted_again_by_table(spark, stored, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="8")
    text = final_plan(stored[1].columns.join(stored[1].views, list(B.BUCKET_KEYS["columns"])))
    assert "SortMergeJoin" in text and not re.search(r"Sort \[", text), text

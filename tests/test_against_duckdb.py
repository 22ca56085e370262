"""Every registered query against DuckDB over the same files."""

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry
from oracle.compare import connect, differences

ORACLE = entry.catalog_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(entry.catalog_queries()) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, con, name):
    assert differences(entry.catalog_queries()[name](spark, SF_DIR), con, ORACLE[name]) == []


def test_flagship_has_rows_and_distinct_columns(spark):
    df = entry.entry(spark)
    assert len(set(df.columns)) == len(df.columns)
    assert df.count() > 1000


def test_every_json_line_is_valid(spark):
    from lodestone.operators.quality import invalid_json

    lines = entry.catalog_queries()["entity_json"](spark, SF_DIR)
    assert lines.count() > 4000
    assert invalid_json(lines).count() == 0

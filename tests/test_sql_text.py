"""Extracts from SQL text."""

import pytest
from conftest import SF_DIR

from lodestone.operators import inventory as I
from lodestone.operators.entities import table_entities
from lodestone.operators.filters import CatalogFilter, connection_rules
from lodestone.plans import sql_text as S
from lodestone.sources.derived import DerivedCatalog

OPERATORS = {"schema": I.schema_inventory, "table": I.table_inventory, "column": I.column_inventory, "procedure": I.routine_inventory}
RULES = CatalogFilter(include=r"^def\.nation_[1-9]", exclude=r"^def\.NATION_12$", exclude_table="_tmp$")


@pytest.fixture(scope="module")
def catalog(spark):
    return DerivedCatalog(spark, SF_DIR, 3)


@pytest.mark.parametrize("rules", [CatalogFilter(), RULES, CatalogFilter(include="^shop", current_database="shop")], ids=["all", "rules", "database"])
@pytest.mark.parametrize("name", OPERATORS)
def test_texts_give_what_the_operators_give(spark, catalog, name, rules):
    text, own = S.text_extract(spark, catalog, name, rules), OPERATORS[name](catalog, rules)
    assert text.columns == own.columns and text.count() > 0
    own = own.select(*(own[c].cast(t).alias(c) for c, t in text.dtypes))
    assert text.exceptAll(own).isEmpty() and own.exceptAll(text).isEmpty()


def test_a_text_of_ones_own(spark, catalog):
    text = "SELECT connection_qn, table_schema, table_name, 'BASE TABLE' AS table_type, upper(engine) AS shouted FROM {tables} WHERE table_rows > :least {without_excluded_tables}"
    rows = S.run_text(spark, catalog, text, {"least": 100_000, "exclude_table": "_TMP$"}, {"without_excluded_tables": "by_rules"})
    kept = catalog.tables.where("table_rows > 100000 and not endswith(table_name, '_TMP')")
    assert rows.count() == kept.count() > 0
    text = "SELECT connection_qn, table_schema, table_name, upper(engine) AS shouted FROM {tables}"
    whole = S.text_extract(spark, catalog, "table", text=text)
    assert whole.columns == ["connection_qn", *I.TABLE_LAYOUT, "shouted"]
    assert table_entities(whole).count() == catalog.tables.count()


@pytest.mark.parametrize("attack", ["x' OR '1'='1", "x') OR (1=1", "'; DROP TABLE t; --", "x\\' OR 1=1 --", ":include", "{tables}"])
def test_no_value_is_read_as_sql(spark, catalog, attack):
    quoted = "\\Q" + attack + "\\E"
    assert S.text_extract(spark, catalog, "schema", CatalogFilter(include=quoted)).isEmpty()
    everything = I.schema_inventory(catalog).count()
    assert S.text_extract(spark, catalog, "schema", CatalogFilter(exclude=quoted)).count() == everything
    assert S.run_text(spark, catalog, "SELECT :x AS x FROM {connections}", {"x": attack}).first().x == attack


def test_what_is_not_there_is_named(spark, catalog):
    with pytest.raises(S.SqlTextError, match="no relation or slot {secrets}"):
        S.run_text(spark, catalog, "SELECT * FROM {secrets}")
    with pytest.raises(S.SqlTextError, match="no choice OR 1=1"):
        S.run_text(spark, catalog, "SELECT * FROM {tables} WHERE true {without_excluded_tables}", {}, {"without_excluded_tables": "OR 1=1"})
    with pytest.raises(S.SqlTextError, match="no value for least"):
        S.run_text(spark, catalog, "SELECT * FROM {tables} WHERE table_rows > :least")
    with pytest.raises(S.SqlTextError, match="one set of rules"):
        S.text_extract(spark, catalog, "table", CatalogFilter(per_connection=connection_rules(spark, {})))
    with pytest.raises(S.SqlTextError, match="connection_qn"):
        S.text_extract(spark, catalog, "table", text="SELECT table_name FROM {tables}")

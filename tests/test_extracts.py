"""Edge rows of the extracts and filters, as literal relations."""

import re

import pytest
from conftest import CONNECTION

from lodestone.operators import filters as F_
from lodestone.operators import inventory as I
from lodestone.operators.constraints import constraint_roles
from lodestone.operators.filters import (
    EXCLUDE_NONE,
    INCLUDE_ALL,
    CatalogFilter,
    connection_rules,
    filter_map_pattern,
    hidden_in_picker,
)
from lodestone.operators.quality import orphan_columns
from pyspark.sql import functions as F


def table(name, schema="app", kind="BASE TABLE", **more):
    return {"table_catalog": "def", "table_schema": schema, "table_name": name, "table_type": kind, **more}


def column(name, in_table, schema="app", **more):
    return {"table_catalog": "def", "table_schema": schema, "table_name": in_table, "column_name": name, **more}


def key(constraint, in_table, name, schema="app"):
    return {"constraint_schema": schema, "constraint_name": constraint, "table_schema": schema, "table_name": in_table,
            "column_name": name}


def constraint(name, in_table, kind, schema="app"):
    return {"constraint_schema": schema, "constraint_name": name, "table_schema": schema, "table_name": in_table,
            "constraint_type": kind}


def test_connection_without_schemas_counts_zero(make_catalog):
    c = make_catalog(schemata=[{"schema_name": "sys"}])
    assert I.database_inventory(c).first().schema_count == 0
    assert I.accessible_table_count(c)["count",].first()["count"] == 0


def test_schema_without_tables(make_catalog):
    row = I.schema_inventory(make_catalog(schemata=[{"schema_name": "app"}])).first()
    assert (row.table_count, row.views_count, row.schema_owner, row.catalog_name) == (0, 0, "mysql", "def")


def test_schema_counts_by_kind(make_catalog):
    kinds = ["BASE TABLE", "SYSTEM VERSIONED", "VIEW", "SYSTEM VIEW", "SEQUENCE"]
    c = make_catalog(schemata=[{"schema_name": "app"}], tables=[table(f"t{i}", kind=k) for i, k in enumerate(kinds)])
    row = I.schema_inventory(c).first()
    assert (row.table_count, row.views_count) == (2, 1)
    assert I.accessible_table_count(c).first()["count"] == 3


def names(df, column="schema_name"):
    return sorted(r[0] for r in df.select(column).collect())


@pytest.mark.parametrize(
    ("rules", "kept"),
    [
        (CatalogFilter(), ["App", "app2", "other"]),
        (CatalogFilter(include=r"^def\.app"), ["App", "app2"]),
        (CatalogFilter(include=r"^def\.app", case_sensitive=True), ["app2"]),
        (CatalogFilter(include=r"^def\.app", exclude="2$"), ["App"]),
        (CatalogFilter(include="app", exclude="app"), []),
        (CatalogFilter(include=r"^db\.app", current_database="db"), ["App", "app2"]),
        (CatalogFilter(include="", exclude="", exclude_table=""), ["App", "app2", "other"]),
    ],
)
def test_include_exclude(make_catalog, rules, kept):
    c = make_catalog(schemata=[{"schema_name": s} for s in ("App", "app2", "other", "mysql", "sys")])
    assert names(I.schema_inventory(c, rules)) == kept


def test_filters_do_not_change_the_database_count_or_the_picker(make_catalog):
    c = make_catalog(schemata=[{"schema_name": s} for s in ("app", "other", "metrics_schema_x", "mysql")])
    assert I.database_inventory(c).first().schema_count == 3
    assert names(I.schema_picker(c)) == ["app", "other"]


def test_picker_patterns(frame):
    df = frame("s string", *[(s,) for s in ("mysql", "mysqlx", "information_schema_2", "sys", "app", "METRICS_SCHEMA1")])
    assert names(df.where(~hidden_in_picker(F.col("s"))), "s") == ["app", "mysqlx"]


def test_per_connection_rules(make_catalog, spark):
    config = connection_rules(
        spark, {"c1": (r"^def\.a", None, None), "c2": (None, r"^def\.a", "^tmp"), "c3": ("", "", "")}
    )
    rows = [{"connection_qn": c, **table(t, schema=s)} for c in ("c1", "c2", "c3") for s in ("a", "b") for t in ("tmp1", "t")]
    kept = I.accessible_tables(make_catalog(tables=rows), CatalogFilter(per_connection=config))
    got = sorted((r.connection_qn, r.table_schema, r.table_name) for r in kept.collect())
    assert got == [
        ("c1", "a", "t"), ("c1", "a", "tmp1"), ("c2", "b", "t"),
        ("c3", "a", "t"), ("c3", "a", "tmp1"), ("c3", "b", "t"), ("c3", "b", "tmp1"),
    ]


def test_many_patterns_give_what_few_do(make_catalog, spark, monkeypatch):
    """Patterns that the plan holds, and patterns that are tried once for each name."""
    rules = {f"c{i}": (r"^def\.[a-m]" if i % 3 else None, r"\.b$", f"_{i % 7}$" if i % 2 else None) for i in range(30)}
    rows = [{"connection_qn": f"c{i}", **table(f"t_{t}", schema=s)} for i in range(32) for s in ("a", "b", "z") for t in range(8)]
    c = make_catalog(tables=rows)
    for default in (None, "_0$"):
        filters = CatalogFilter(per_connection=connection_rules(spark, rules), exclude_table=default)
        expected = set()
        for row in rows:
            include, exclude, in_table = rules.get(row["connection_qn"], (None, None, None))
            place, in_table = f"def.{row['table_schema']}", in_table or default
            if re.search(include or "", place) and not (exclude and re.search(exclude, place)) and not (in_table and re.search(in_table, row["table_name"])):
                expected.add((row["connection_qn"], row["table_schema"], row["table_name"]))
        for most in (64, 2):
            monkeypatch.setattr(F_, "LITERAL_PATTERNS", most)
            kept = I.accessible_tables(c, filters)
            assert sorted((r.connection_qn, r.table_schema, r.table_name) for r in kept.collect()) == sorted(expected)


def test_no_row_of_the_source_meets_a_pattern_column(make_catalog, spark):
    rows = [{"connection_qn": "c1", **table(f"t{i}")} for i in range(9)]
    filters = CatalogFilter(per_connection=connection_rules(spark, {"c1": ("^def", "x$", "_tmp$"), "c2": (None, "^y", "_old$")}))
    plan = I.accessible_tables(make_catalog(tables=rows), filters)._jdf.queryExecution().optimizedPlan().toString()
    assert set(re.findall(r"RLIKE\((\w+)#\d+, concat", plan)) == {"schema_key"}
    assert "(?iu)_tmp$" in plan and "(?iu)_old$" in plan


def test_no_rules_at_all(make_catalog, spark):
    c = make_catalog(tables=[table("t")])
    assert I.accessible_tables(c, CatalogFilter(per_connection=connection_rules(spark, {}))).count() == 1


@pytest.mark.parametrize(
    ("selection", "pattern"),
    [
        ({}, INCLUDE_ALL),
        ({"^def$": ["^e2e_main$"]}, r"^def\.e2e_main$"),
        ({"^def$": ["^a$", "^b.*$"]}, r"^def\.a$|^def\.(?:b.*)$"),
        ({"^def$": []}, r"^def\."),
    ],
)
def test_filter_map(selection, pattern):
    assert filter_map_pattern(selection, INCLUDE_ALL) == pattern
    assert filter_map_pattern({}, EXCLUDE_NONE) == EXCLUDE_NONE


def test_size_is_zero_when_one_length_is_unknown(make_catalog):
    c = make_catalog(tables=[table("a", data_length=100), table("b", data_length=100, index_length=20)])
    assert {r.table_name: r.size_bytes for r in I.table_inventory(c).collect()} == {"a": 0, "b": 120}


def test_table_without_columns_and_column_count_before_filters(make_catalog):
    c = make_catalog(tables=[table("a"), table("b")], columns=[column("x", "a"), column("x", "a"), column("y", "a")])
    assert {r.table_name: r.column_count for r in I.table_inventory(c).collect()} == {"a": 3, "b": 0}


def part(in_table, method, name):
    return {"table_schema": "app", "table_name": in_table, "partition_method": method, "partition_name": name}


def test_partitions(make_catalog):
    rows = [part("a", None, None), *[part("b", "RANGE", n) for n in ("p2", "p1", "p2", None, "p10")], part("c", "HASH", None)]
    c = make_catalog(tables=[table(t) for t in "abcd"], partitions=rows)
    got = {
        r.table_name: (r.is_partition, r.partition_strategy, r.partition_count, r.partitions)
        for r in I.table_inventory(c).collect()
    }
    assert got == {
        "a": (False, None, 0, None),
        "b": (True, "RANGE", 5, "p1,p10,p2,p2"),
        "c": (True, "HASH", 1, None),
        "d": (False, None, 0, None),
    }


def test_only_views_are_marked_insertable(make_catalog):
    c = make_catalog(
        tables=[table("t"), table("v", kind="VIEW")],
        views=[{"table_schema": "app", "table_name": "v", "view_definition": "select 1"}] * 3,
    )
    got = {r.table_name: (r.is_insertable_into, r.view_definition) for r in I.table_inventory(c).collect()}
    assert got == {"t": ("NO", None), "v": ("YES", "select 1")}


def test_key_roles(make_catalog):
    c = make_catalog(
        key_column_usage=[
            key("PRIMARY", "t", "id"), key("fk_a", "t", "id"), key("fk_a", "t", "ref"), key("fk_b", "t", "ref"),
            key("uk", "t", "code"), key("PRIMARY", "t", "id"), key("lost", "t", "x"),
        ],
        table_constraints=[
            constraint("PRIMARY", "t", "PRIMARY KEY"), constraint("fk_a", "t", "FOREIGN KEY"),
            constraint("fk_b", "t", "FOREIGN KEY"), constraint("uk", "t", "UNIQUE"),
            constraint("PRIMARY", "t", "PRIMARY KEY"), constraint("PRIMARY", "other", "PRIMARY KEY"),
        ],
    )
    got = {r.column_name: (r.constraint_type, r.constraint_name) for r in constraint_roles(c).collect()}
    assert got == {"id": ("PRIMARY KEY", "PRIMARY"), "ref": ("FOREIGN KEY", None)}


def test_two_rules_for_a_connection_fail_instead_of_doubling_rows(make_catalog, spark):
    c = make_catalog("c1", tables=[table("a")])
    rules = connection_rules(spark, {"c1": ("def", None, None)})
    assert I.accessible_tables(c, CatalogFilter(per_connection=rules)).count() == 1
    with pytest.raises(Exception, match="several rules for connection c1"):
        I.accessible_tables(c, CatalogFilter(per_connection=rules.unionByName(rules))).collect()


def test_case_is_ignored_beyond_ascii_and_for_system_schemas(make_catalog):
    c = make_catalog(schemata=[{"schema_name": n} for n in ("ÉCOLE", "Mysql", "PERFORMANCE_schema", "other")])
    shown = lambda rules: sorted(r.schema_name for r in I.schema_inventory(c, rules).collect())
    assert shown(CatalogFilter()) == ["other", "ÉCOLE"]
    assert shown(CatalogFilter(include="école")) == ["ÉCOLE"]
    assert shown(CatalogFilter(include="école|MYSQL|other", case_sensitive=True)) == ["other"]
    assert "Mysql" in shown(CatalogFilter(case_sensitive=True))


def test_lengths_that_print_alike_are_one_row(make_catalog):
    same = {"numeric_precision": 0, "ordinal_position": 1}
    c = make_catalog(tables=[table("t")], columns=[column("a", "t", **same), column("a", "t", character_maximum_length=0, **same)])
    assert I.column_inventory(c).count() == 1


def test_columns_without_a_kept_table(make_catalog):
    c = make_catalog(
        tables=[table("t"), table("sv", kind="SYSTEM VIEW"), table("x_tmp")],
        columns=[column("a", "t"), column("a", "t"), column("a", "sv"), column("a", "gone"), column("a", "x_tmp"), column("a", "t", "sys")],
    )
    rules = CatalogFilter(exclude_table="_TMP$")
    assert [(r.table_name, r.column_name) for r in I.column_inventory(c, rules).collect()] == [("t", "a")]
    assert {(r.table_name, r.reason) for r in orphan_columns(c, rules).collect()} == {("gone", "no_table"), ("sv", "other_kind")}


def test_column_rules(make_catalog):
    c = make_catalog(
        tables=[table("t")],
        columns=[
            column("a", "t", ordinal_position=1, generation_expression=None, extra="auto_increment", numeric_precision=10, numeric_scale=2),
            column("b", "t", ordinal_position=2, generation_expression="", extra="", character_maximum_length=20, character_octet_length=80),
            column("c", "t", ordinal_position=3, generation_expression="a+1", extra=None),
        ],
    )
    a, b, last = I.column_inventory(c, ordered=True).collect()
    assert [(r.is_generated, r.is_generatedcolumn) for r in (a, b, last)] == [("NO", "NO"), ("YES", "NO"), ("YES", "YES")]
    assert [r.is_auto_increment for r in (a, b, last)] == ["YES", "NO", "NO"] == [r.is_autoincrement for r in (a, b, last)]
    assert [r.column_size for r in (a, b, last)] == [10, 20, None]
    assert [r.max_length for r in (a, b, last)] == [0, 20, 0]
    assert (a.num_prec_radix, a.decimal_digits, a.numeric_scale, b.buffer_length) == (2, 2, 2, 80)
    assert I.column_inventory(c).columns == ["connection_qn", *I.COLUMN_LAYOUT]
    assert I.table_inventory(c).columns == ["connection_qn", *I.TABLE_LAYOUT]
    assert (len(I.COLUMN_LAYOUT), len(I.TABLE_LAYOUT)) == (38, 39)


def _both(make_catalog, connections):
    def rows(relation):
        return [{"connection_qn": c, **r} for c in connections for r in relation]

    t = [table("t", row_count=1), table("v", kind="VIEW")]
    return make_catalog(
        connections=[{"connection_qn": c} for c in connections],
        schemata=rows([{"schema_name": "app"}, {"schema_name": "sys"}]),
        tables=rows([{k: v for k, v in r.items() if k != "row_count"} for r in t]),
        columns=rows([column("id", "t"), column("id", "v")]),
        partitions=rows([part("t", "RANGE", "p0")]),
        views=rows([{"table_schema": "app", "table_name": "v", "view_definition": "select 1"}]),
        key_column_usage=rows([key("PRIMARY", "t", "id")]),
        table_constraints=rows([constraint("PRIMARY", "t", "PRIMARY KEY")]),
        routines=rows([{"routine_schema": "app", "routine_name": "r", "routine_type": "FUNCTION"}]),
    )


@pytest.mark.parametrize(
    "extract",
    [I.database_inventory, I.schema_inventory, I.schema_picker, I.accessible_table_count, I.tables_per_schema,
     I.table_inventory, I.partition_summary, constraint_roles, I.column_inventory, I.routine_inventory],
)
def test_two_connections_are_two_single_runs(make_catalog, extract):
    """Same names everywhere: a join that forgot the connection would multiply rows."""
    together = sorted(map(str, extract(_both(make_catalog, ["c1", "c2"])).collect()))
    apart = [str(r) for c in ("c1", "c2") for r in extract(_both(make_catalog, [c])).collect()]
    assert together == sorted(apart) and apart


def test_an_excluded_schema_changes_nothing(make_catalog):
    rules = CatalogFilter(exclude=r"^def\.extra$")
    plain = make_catalog(schemata=[{"schema_name": "app"}], tables=[table("t")], columns=[column("a", "t")])
    more = make_catalog(
        schemata=[{"schema_name": "app"}, {"schema_name": "extra"}],
        tables=[table("t"), table("t", schema="extra")],
        columns=[column("a", "t"), column("a", "t", schema="extra")],
    )
    for extract in (I.schema_inventory, I.table_inventory, I.column_inventory):
        assert extract(plain, rules).collect() == extract(more, rules).collect()
    assert CONNECTION

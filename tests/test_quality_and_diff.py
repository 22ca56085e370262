"""Entity checks and snapshot differences on small cases."""

import pytest
from conftest import CONNECTION
from test_extracts import column, table

from lodestone.operators import diff as D
from lodestone.operators import entities as E
from lodestone.operators import quality as Q
from lodestone.operators.settings import latest_settings
from lodestone.plans.extraction import EntityStreams
from pyspark.sql import functions as F


@pytest.fixture
def streams(make_catalog):
    return EntityStreams(
        make_catalog(
            schemata=[{"schema_name": "app"}, {"schema_name": "empty"}],
            tables=[table("t"), table("u", table_rows=5), table("v", kind="VIEW")],
            columns=[column("id", "t", ordinal_position=1), column("id", "v", ordinal_position=1)],
            routines=[{"routine_schema": "app", "routine_name": "x", "routine_type": k} for k in ("PROCEDURE", "FUNCTION")],
        )
    )


def test_a_sound_catalog_has_no_violations(streams):
    every = list(streams.values())
    assert Q.hierarchy_violations(every[1:], every[:-1]).isEmpty()
    assert all(Q.wrong_constants(df, "mysql", "default").isEmpty() for df in every)
    assert all(Q.bad_references(df).isEmpty() for df in every)
    assert Q.parent_conflicts(streams["column"]).isEmpty()
    assert Q.unexpected_stream_types(streams).isEmpty()
    missing = Q.missing_attributes(streams["table"], {t: Q.REQUIRED_ATTRIBUTES[t] for t in ("Table", "View")})
    assert missing.where("missing > 0").isEmpty() and missing.count() == 14 + 13
    lines = streams["column"].select(E.entity_json(streams["column"]).alias("value"))
    assert Q.invalid_json(lines).isEmpty()


def test_shared_qualified_name_is_reported(streams):
    rows = Q.duplicate_qualified_names(streams["procedure"]).collect()
    assert [(r.qualifiedName, r.n) for r in rows] == [(f"{CONNECTION}/def/app/_procedures_/x", 2)]


def test_sibling_with_a_common_prefix_is_not_below(frame, streams):
    moved = streams["table"].withColumn(
        "attributes", F.col("attributes").withField("qualifiedName", F.lit(f"{CONNECTION}/def/app2/t"))
    )
    rows = Q.hierarchy_violations([moved], [streams["schema"]]).collect()
    assert {r.violation for r in rows} == {"not_below_parent"}


def test_names_of_equal_numbers_are_told_apart(streams):
    """With forged numbers, every parent collides with every other; the names decide."""
    every = list(streams.values())
    kept = [df.where("attributes.name <> 't'") if "customAttributes" in df.columns else df for df in every]
    expected = sorted(map(tuple, Q.hierarchy_violations(every, kept[:-1]).collect()))
    assert {(r[0], r[3]) for r in expected} == {("Column", "parent_missing"), ("Database", "parent_missing")}
    for forged in (lambda c: (F.lit(1).cast("bigint"),) * 2, lambda c: (F.length(c).cast("bigint"), F.lit(0).cast("bigint"))):
        assert sorted(map(tuple, Q.hierarchy_violations(every, kept[:-1], forged).collect())) == expected


def test_parents_are_joined_by_number(streams, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    every = list(streams.values())
    df = Q.hierarchy_violations(every[1:], every[:-1])
    plan = df._jdf.queryExecution().executedPlan().toString()
    join = next(line for line in plan.splitlines() if "LeftAnti" in line)
    keys = join[join.index("[") : join.index("LeftAnti")]
    assert "p1" in keys and "k1" in keys and "known" not in keys and "Name" not in keys


def test_floors(spark, streams):
    got = {r.typeName: (r.n, r.ok) for r in Q.count_floors(spark, list(streams.values()), {"Table": 2, "View": 2, "Job": 1}).collect()}
    assert got == {"Table": (2, True), "View": (1, False), "Job": (0, False)}


@pytest.mark.parametrize("line", ['{"typeName":"T","attributes":{"qualifiedName":NaN}}', '{"typeName":"T"}', "{", "[]"])
def test_invalid_lines(frame, line):
    good = '{"typeName":"T","attributes":{"qualifiedName":"q"}}'
    df = frame("value string", (line,), (good,))
    assert [r.value for r in Q.invalid_json(df).collect()] == [line]


def changes(df):
    return {(r.connection_qn, r.qualifiedName.rsplit("/", 1)[1]): r.change for r in df.collect()}


def test_changes(make_catalog):
    def snapshot(**rows):
        tables = [{"connection_qn": c, **table(n, table_rows=r)} for c, names in rows.items() for n, r in names.items()]
        return EntityStreams(make_catalog(tables=tables))["table"]

    old = snapshot(c1={"a": 1, "b": 1, "c": 1}, c2={"a": 1}, c3={"z": 1})
    new = snapshot(c1={"a": 1, "b": 2, "d": 1}, c2={"a": 1, "e": 1})
    got = changes(D.snapshot_diff(old, new))
    assert got == {
        ("c1", "a"): "unchanged", ("c1", "b"): "update", ("c1", "c"): "archive", ("c1", "d"): "insert",
        ("c2", "a"): "unchanged", ("c2", "e"): "insert",
    }
    assert set(changes(D.incremental_changes(old, new)).values()) == {"update", "archive", "insert"}
    empty = old.limit(0)
    assert D.snapshot_diff(old, empty).isEmpty()
    assert [r.connection_qn for r in D.undelivered_connections(old, new).collect()] == ["c3"]
    with pytest.raises(D.EmptySnapshotError):
        D.refuse_empty(empty, old)
    D.refuse_empty(empty, empty)
    D.refuse_empty(new, old)


def test_moved_value_is_a_change(make_catalog):
    """The same value in another attribute must not look unchanged."""

    def snapshot(**more):
        return EntityStreams(make_catalog(routines=[{"routine_schema": "s", "routine_name": "r", "routine_type": "FUNCTION", **more}]))["procedure"]

    assert set(changes(D.snapshot_diff(snapshot(definer="x"), snapshot(routine_comment="x"))).values()) == {"update"}


def test_shared_names_do_not_pair_up(spark, streams):
    procedures = streams["procedure"]
    copies = procedures.join(spark.range(300).select(F.lit(1).alias("one"), "id"), F.lit(True)).drop("one", "id")
    assert list(changes(D.snapshot_diff(copies, procedures)).values()) == ["unchanged"]
    one = procedures.where(F.col("attributes.subType") == "FUNCTION")
    assert list(changes(D.snapshot_diff(procedures, one)).values()) == ["update"]


def test_last_setting_wins_and_extra_is_nested(frame):
    df = frame(
        "connection_qn string, key string, value string, seq int",
        ("c", "host", "a", 1), ("c", "host", "b", 2), ("c", "extra.database", "d", 1), ("c", "extra.host", "e", 3),
        ("d", "host", "z", 1),
    )
    got = {(r.connection_qn, r.section, r.key): r.value for r in latest_settings(df).collect()}
    assert got == {("c", "", "host"): "b", ("c", "extra", "database"): "d", ("c", "extra", "host"): "e", ("d", "", "host"): "z"}
    assert latest_settings(df.limit(0)).isEmpty()


def test_one_pass_finds_what_the_checks_find(streams):
    """Faults of every kind in one stream, against each check on its own."""
    a = F.col("attributes")
    faulty = streams["column"].withColumn("attributes", a.withField("dataType", F.when(a["viewName"].isNull(), a["dataType"])))
    faulty = faulty.withColumn("attributes", F.col("attributes").withField("tenantId", F.lit(None).cast("string")))
    faulty = faulty.withColumn("attributes", F.col("attributes").withField("viewName", F.coalesce("attributes.viewName", F.lit("v"))))
    mixed = {"column": faulty, "table": streams["table"], "schema": streams["schema"], "database": streams["schema"], "procedure": streams["procedure"]}
    found = Q.findings(mixed, "mysql", "default").collect()

    def names(check, stream="column"):
        return sorted((r.typeName, r.qualifiedName) for r in found if (r.check, r.stream) == (check, stream))

    for check, rows in {
        "parent_conflict": Q.parent_conflicts(faulty), "bad_reference": Q.bad_references(faulty), "wrong_constant": Q.wrong_constants(faulty, "mysql", "default"),
    }.items():
        assert names(check) == sorted(map(tuple, rows.collect())), check
    missing = {r.attribute: r.missing for r in Q.missing_attributes(faulty, {"Column": Q.REQUIRED_ATTRIBUTES["Column"]}).collect() if r.missing}
    counted = {}
    for r in found:
        if (r.stream, r.check) == ("column", "missing_attribute"):
            counted[r.detail] = counted.get(r.detail, 0) + 1
    assert counted == missing == {"dataType": 1, "tenantId": 2}
    assert len(names("unexpected_type", "database")) == streams["schema"].count() == 2
    assert not [r for r in found if r.stream in ("table", "schema", "procedure") or r.check == "invalid_json"]


def test_all_checks_are_one_scan_of_each_stream(spark, streams):
    for name, df in streams.items():
        text = Q.findings({name: df}, "mysql", "default")._jdf.queryExecution().optimizedPlan().toString()
        alone = df._jdf.queryExecution().optimizedPlan().toString()
        leaves = ("LocalRelation", "LogicalRDD", "Range")
        assert sum(text.count(leaf) for leaf in leaves) <= sum(alone.count(leaf) for leaf in leaves)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_no_filter_makes_and_parses_lines(spark, make_catalog):
    """A condition that makes the line itself would be moved below the projection, into a filter."""
    streams = EntityStreams(make_catalog("default/mysql/1", schemata=[{"schema_name": "s"}]))
    lines = streams["schema"].select(E.entity_json(streams["schema"]).alias("value"))
    for df in (Q.invalid_json(lines), Q.findings({"schema": streams["schema"]}, "mysql", "default")):
        plan = plan_of(df)
        assert "parseJson" in plan
        assert not [line for line in plan.splitlines() if "Filter" in line and "Json" in line]


def test_lines_are_judged_as_by_three_parses(frame):
    held = '{"typeName":%s,"attributes":{"qualifiedName":%s}}'
    values = ['"a"', "null", "5", "1.5", "true", "{}", "[]", '""', "NaN", '"é\\n"', "01"]
    lines = [held % (a, b) for a in values for b in values]
    lines += [held % ('"a"', '"q"') + tail for tail in (" ", " x", "{}")] + ["", "null", "5", "[]", "{", "{}", '{"typeName":"a"}']
    lines += ['{"typeName":"a","attributes":null}', '{"typeName":"a","attributes":[{"qualifiedName":"q"}]}', "[" + held % ('"a"', '"q"') + "]"]
    df = frame("value string", *((line,) for line in lines))
    sound = (
        F.try_parse_json("value").isNotNull()
        & F.get_json_object("value", "$.typeName").isNotNull()
        & F.get_json_object("value", "$.attributes.qualifiedName").isNotNull()
    )
    expected = sorted(r.value for r in df.where(~sound).collect())
    assert sorted(r.value for r in Q.invalid_json(df).collect()) == expected and 20 < len(expected) < len(lines)

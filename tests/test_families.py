"""Attributes of a server family's own, and several families in one run."""

import pytest
from pyspark.sql import functions as F

from lodestone.dialect import Dialect
from lodestone.operators import entities as E
from lodestone.plans.families import Family, FamilyStreams, MapperError
from lodestone.plans.extraction import EntityStreams
from test_extracts import column, table


def families_of(frame, *pairs):
    return frame("connection_qn string, family string", *pairs)


def test_builders_are_tried_when_they_are_registered(spark):
    family = Family()
    with pytest.raises(MapperError, match="no stream tables"):
        family.with_attribute(spark, "tables", "description", lambda rows, stamp: F.lit("x"))
    with pytest.raises(MapperError, match="qualifiedName is a key"):
        family.with_attribute(spark, "table", "qualifiedName", lambda rows, stamp: F.lit("x"))
    with pytest.raises(MapperError, match="table.rowCount is bigint, not string"):
        family.with_attribute(spark, "table", "rowCount", lambda rows, stamp: F.lit("x"))
    with pytest.raises(MapperError, match="not_there"):
        family.with_attribute(spark, "table", "description", lambda rows, stamp: F.col("not_there"))
    with pytest.raises(MapperError, match="no customAttributes"):
        family.with_attribute(spark, "schema", "x", lambda rows, stamp: F.lit("x"), custom=True)
    more = family.with_attribute(spark, "table", "rowCount", lambda rows, stamp: F.col("row_count") * 2)
    assert family.attributes == {} and set(more.attributes["table"]) == {"rowCount"}


def test_two_families_in_one_run(spark, make_catalog, frame):
    rows = [{"connection_qn": c, **table("t", table_rows=3, table_comment="hi", schema=s)} for c in ("a/b/1", "a/b/2", "a/b/3") for s in ("app", "odd")]
    columns = [{"connection_qn": c, **column("id", "t")} for c in ("a/b/1", "a/b/2")]
    catalog = make_catalog(tables=rows, columns=columns)
    second = Family(Dialect(system_schemas=("odd",))).with_attribute(spark, "table", "description", lambda r, stamp: F.upper("remarks"))
    second = second.with_attribute(spark, "table", "warmth", lambda r, stamp: F.lit(7)).with_attribute(spark, "table", "engine", lambda r, stamp: F.lit("e"), custom=True)
    streams = FamilyStreams(catalog, {"x": Family(), "y": second}, families_of(frame, ("a/b/1", "x"), ("a/b/2", "y")))
    found = {(r.connection_qn, r.attributes.schemaName): (r.attributes.description, r.attributes.warmth, r.customAttributes.engine) for r in streams["table"].collect()}
    assert found == {("a/b/1", "app"): ("hi", None, ""), ("a/b/1", "odd"): ("hi", None, ""), ("a/b/2", "app"): ("HI", 7, "e")}
    lines = {r.value for r in streams["table"].select(E.entity_json(streams["table"]).alias("value")).collect()}
    assert sum('"warmth":7' in line for line in lines) == 1
    assert streams["column"].count() == 2 and set(streams) == set(EntityStreams(catalog)) and len(streams) == 5


def test_a_connection_of_two_families_fails(make_catalog, frame):
    catalog = make_catalog(tables=[{"connection_qn": "c", **table("t")}])
    streams = FamilyStreams(catalog, {"x": Family(), "y": Family()}, families_of(frame, ("c", "x"), ("c", "y")))
    with pytest.raises(Exception, match="several families for connection c"):
        streams["table"].collect()

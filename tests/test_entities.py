"""Mapper rules on single records, checked in the JSON form consumers read."""

import datetime as dt
import json

import pytest
from conftest import CONNECTION

from lodestone.operators import entities as E


@pytest.fixture
def wire(spark):
    def run(mapper, stamp=E.PLAIN, ddl=None, **record):
        record = {"connection_qn": CONNECTION, **record}
        schema = ddl or ", ".join(f"{k} {_ddl(v)}" for k, v in record.items())
        df = mapper(spark.createDataFrame([tuple(record.values())], schema), stamp)
        return json.loads(df.select(E.entity_json(df).alias("v")).first().v)

    return run


def _ddl(value):
    if isinstance(value, bool):
        return "boolean"
    return {int: "bigint", float: "double", str: "string", dt.datetime: "timestamp_ntz"}.get(type(value), "string")


TABLE = {"table_catalog": "def", "table_schema": "harbour", "table_name": "vessels", "table_kind": "BASE TABLE"}
COLUMN = {"table_catalog": "def", "table_schema": "harbour", "table_name": "vessels", "column_name": "callsign",
          "table_type": "BASE TABLE"}
ROUTINE = {"procedure_catalog": "def", "procedure_schema": "harbour", "procedure_name": "tally_docks",
           "procedure_definition": "BEGIN SELECT 7 * 6; END", "procedure_type": "PROCEDURE"}


def test_database(wire):
    e = wire(E.database_entities, database_name="def", schema_count=5)
    assert e["typeName"] == "Database" and e["status"] == "ACTIVE"
    assert e["attributes"] == {
        "name": "def",
        "qualifiedName": f"{CONNECTION}/def",
        "connectionQualifiedName": CONNECTION,
        "connectorName": "mysql",
        "tenantId": "default",
        "schemaCount": 5,
    }
    assert "customAttributes" not in e


def test_database_name_falls_back(wire):
    assert wire(E.database_entities, datname="def")["attributes"]["name"] == "def"


def test_connection_name_and_tenant_are_stamped(wire):
    e = wire(E.database_entities, E.Stamp(tenant_id="t1", connection_name="north pier"), database_name="def")
    assert e["attributes"]["connectionName"] == "north pier" and e["attributes"]["tenantId"] == "t1"


def test_schema(wire):
    a = wire(E.schema_entities, catalog_name="def", schema_name="harbour", table_count=14, views_count=6)["attributes"]
    assert a["qualifiedName"] == f"{CONNECTION}/def/harbour"
    assert (a["databaseName"], a["tableCount"], a["viewsCount"]) == ("def", 14, 6)
    assert a["database"] == {"typeName": "Database", "uniqueAttributes": {"qualifiedName": f"{CONNECTION}/def"}}
    assert "description" not in a


def test_table(wire):
    e = wire(
        E.table_entities, **TABLE, column_count=5, row_count=412, size_bytes=73_000, is_partition=False,
        partition_count=0, remarks=None, create_time=dt.datetime(2019, 3, 7), engine="InnoDB", version=10,
        row_format="Dynamic", data_length=4194304.0, table_collation=None, create_options="",
    )
    a = e["attributes"]
    assert e["typeName"] == "Table"
    assert a["qualifiedName"] == f"{CONNECTION}/def/harbour/vessels"
    assert (a["columnCount"], a["rowCount"], a["subType"], a["sizeBytes"]) == (5, 412, "TABLE", 73_000)
    assert (a["isPartitioned"], a["partitionCount"], a["description"]) == (False, 0, "")
    assert a["sourceCreatedAt"] == 1551916800000
    assert a[E.SCHEMA_REF]["uniqueAttributes"]["qualifiedName"] == f"{CONNECTION}/def/harbour"
    assert "definition" not in a
    assert e["customAttributes"] == {
        "engine": "InnoDB", "version": "10", "row_format": "Dynamic", "data_length": "4194304",
        "table_collation": "", "create_options": "", "is_transient": "",
    }
    assert "defaultCatalogName" not in e and "relationshipAttributes" not in e


def test_system_versioned_is_a_table(wire):
    assert wire(E.table_entities, **{**TABLE, "table_kind": "system versioned"})["typeName"] == "Table"


@pytest.mark.parametrize("kind", ["VIEW", "SYSTEM VIEW", "view"])
def test_view(wire, kind):
    e = wire(
        E.table_entities, **{**TABLE, "table_kind": kind, "table_name": "v"}, view_definition="SELECT 1",
        remarks="At berth today", row_count=0,
    )
    a = e["attributes"]
    assert e["typeName"] == "View"
    assert a["definition"] == "CREATE OR REPLACE VIEW v AS SELECT 1"
    assert a["description"] == "At berth today"
    assert not {"rowCount", "subType", "isPartitioned", "partitionCount"} & set(a)
    assert (e["defaultCatalogName"], e["defaultSchemaName"]) == ("def", "harbour")


@pytest.mark.parametrize("body", [None, ""])
def test_view_without_body(wire, body):
    e = wire(E.table_entities, **{**TABLE, "table_kind": "VIEW"}, view_definition=body)
    assert e["attributes"]["definition"] == ""


@pytest.mark.parametrize("created", [None, dt.datetime(1970, 1, 1), "some day"])
def test_unset_creation_time_is_absent(wire, created):
    assert "sourceCreatedAt" not in wire(E.table_entities, **TABLE, create_time=created)["attributes"]


def test_column(wire):
    e = wire(
        E.column_entities, **COLUMN, data_type="VarChar", max_length=48, is_nullable="YES", ordinal_position=3,
        constraint_type="", numeric_precision=None, character_octet_length=None, buffer_length=None,
        column_size=48,
    )
    a, c = e["attributes"], e["customAttributes"]
    assert a["qualifiedName"] == f"{CONNECTION}/def/harbour/vessels/callsign"
    assert (a["dataType"], a["maxLength"], a["isNullable"], a["order"]) == ("VARCHAR", 48, True, 3)
    assert (a["isPrimary"], a["isForeign"], a["isPartition"], a["precision"]) == (False, False, False, 0)
    assert a["tableName"] == "vessels" and a["table"]["typeName"] == "Table"
    assert not {"view", "viewName", "viewQualifiedName"} & set(a)
    assert set(c) == {*E.COLUMN_CUSTOM, "type_name"} and len(c) == 22
    assert c["type_name"] == "varchar"
    assert c["numeric_precision"] is None and c["buffer_length"] == "" and c["ordinal_position"] == 3
    assert c["is_self_referencing"] == "" and c["column_size"] == 48


def test_known_length_is_a_number(wire):
    e = wire(E.column_entities, **COLUMN, buffer_length=96, character_octet_length=96)
    assert e["customAttributes"]["buffer_length"] == 96 and e["customAttributes"]["character_octet_length"] == 96


def test_view_column(wire):
    a = wire(E.column_entities, **{**COLUMN, "table_type": "VIEW"})["attributes"]
    assert a["viewName"] == "vessels" and a["view"]["typeName"] == "View"
    assert not {"table", "tableName", "tableQualifiedName"} & set(a)


@pytest.mark.parametrize(
    ("constraint", "flags"),
    [("PRIMARY KEY", (True, False)), ("FOREIGN KEY", (False, True)), (None, (False, False)), ("UNIQUE", (False, False))],
)
def test_key_flags(wire, constraint, flags):
    a = wire(E.column_entities, **COLUMN, constraint_type=constraint)["attributes"]
    assert (a["isPrimary"], a["isForeign"]) == flags


@pytest.mark.parametrize(("value", "expected"), [("YES", True), ("NO", False), (None, False)])
def test_nullable_flag(wire, value, expected):
    assert wire(E.column_entities, **COLUMN, is_nullable=value)["attributes"]["isNullable"] is expected


def test_nullable_defaults_to_yes_only_when_the_column_is_absent(wire):
    assert wire(E.column_entities, **COLUMN)["attributes"]["isNullable"] is True


@pytest.mark.parametrize("weak", [float("nan"), float("inf"), float("-inf"), None])
def test_numbers_that_json_does_not_know(wire, weak):
    names = ("numeric_precision", "column_size", "max_length", "numeric_scale", "buffer_length", "ordinal_position")
    ddl = "connection_qn string, " + ", ".join(f"{k} string" for k in COLUMN) + ", " + ", ".join(f"{n} double" for n in names)
    e = wire(E.column_entities, ddl=ddl, **COLUMN, **dict.fromkeys(names, weak))
    assert (e["attributes"]["precision"], e["attributes"]["maxLength"], e["attributes"]["numericScale"]) == (0, 0, 0)
    assert e["customAttributes"]["numeric_precision"] is None and e["customAttributes"]["buffer_length"] == ""


def test_procedure(wire):
    a = wire(
        E.procedure_entities, **ROUTINE, source_owner="keeper@%", remarks="tallies", created=dt.datetime(2018, 5, 4),
        last_altered=dt.datetime(2018, 5, 6),
    )["attributes"]
    assert a["qualifiedName"] == f"{CONNECTION}/def/harbour/_procedures_/tally_docks"
    assert (a["definition"], a["subType"], a["description"]) == ("BEGIN SELECT 7 * 6; END", "PROCEDURE", "tallies")
    assert (a["sourceCreatedBy"], a["sourceCreatedAt"], a["sourceUpdatedAt"]) == ("keeper@%", 1525392000000, 1525564800000)
    assert a[E.SCHEMA_REF]["typeName"] == "Schema"


def test_function_without_body_owner_or_catalog(wire):
    record = {**ROUTINE, "procedure_definition": None, "procedure_type": "FUNCTION", "source_owner": ""}
    del record["procedure_catalog"]
    a = wire(E.procedure_entities, **record)["attributes"]
    assert (a["definition"], a["subType"], a["databaseName"]) == ("", "FUNCTION", "def")
    assert not {"sourceCreatedBy", "sourceCreatedAt", "sourceUpdatedAt"} & set(a)

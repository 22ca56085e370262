"""The source relations and where to read them from.

Every relation is keyed by `connection_qn` first, so that any number of connections can be read, joined and
aggregated in one run without matching names across connections.
"""

from __future__ import annotations

from collections.abc import Iterable
from types import SimpleNamespace
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "timestamp_ntz": T.TimestampNTZType()}


def _schema(own: str = "") -> T.StructType:
    """Layout from "name type, ..." after the connection (built without a session, unlike a DDL string)."""
    columns = [part.split() for part in own.split(",") if part]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in [["connection_qn", "string"], *columns]])


# The columns read from each information_schema relation. DATETIME columns carry no zone.
RELATION_SCHEMAS: dict[str, T.StructType] = {
    "connections": _schema(),
    "schemata": _schema("schema_name string"),
    "tables": _schema(
        "table_catalog string, table_schema string, table_name string, table_type string, engine string, "
        "version bigint, row_format string, table_rows bigint, data_length bigint, index_length bigint, "
        "auto_increment bigint, create_time timestamp_ntz, table_collation string, create_options string, "
        "table_comment string"
    ),
    "columns": _schema(
        "table_catalog string, table_schema string, table_name string, column_name string, "
        "ordinal_position bigint, column_default string, is_nullable string, data_type string, "
        "character_maximum_length bigint, character_octet_length bigint, numeric_precision bigint, "
        "numeric_scale bigint, character_set_name string, collation_name string, column_type string, "
        "column_key string, extra string, privileges string, column_comment string, generation_expression string"
    ),
    "partitions": _schema("table_schema string, table_name string, partition_method string, partition_name string"),
    "views": _schema("table_schema string, table_name string, view_definition string"),
    "key_column_usage": _schema(
        "constraint_schema string, constraint_name string, table_schema string, table_name string, "
        "column_name string"
    ),
    "table_constraints": _schema(
        "constraint_schema string, constraint_name string, table_schema string, table_name string, "
        "constraint_type string"
    ),
    "routines": _schema(
        "routine_schema string, routine_name string, definer string, routine_definition string, "
        "routine_type string, routine_comment string, created timestamp_ntz, last_altered timestamp_ntz"
    ),
}


class Catalog(Protocol):
    """One DataFrame per source relation; `connections` lists every connection, also those with no schema."""

    connections: DataFrame
    schemata: DataFrame
    tables: DataFrame
    columns: DataFrame
    partitions: DataFrame
    views: DataFrame
    key_column_usage: DataFrame
    table_constraints: DataFrame
    routines: DataFrame


def catalog_from(relations: dict[str, DataFrame]) -> Catalog:
    """A catalog of named DataFrames, checking that none is missing."""
    missing = [name for name in RELATION_SCHEMAS if name not in relations]
    if missing:
        raise ValueError(f"missing catalog relations: {', '.join(missing)}")
    return SimpleNamespace(**relations)


def in_part(key: str, part: int, parts: int) -> Column:
    """Whether a row is in one of `parts` parts, by the hash of one column; all nulls are in the same one."""
    return F.pmod(F.xxhash64(key), F.lit(parts)) == part


class TablePart(Catalog):
    """One of `parts` parts of a catalog's tables, with all rows that are of them; relations that are not of tables are whole. Tables of
    one name are in the same part, so that all joins by table stay within one, and the rows of all parts are those of the catalog."""

    def __init__(self, catalog: Catalog, part: int, parts: int):
        self._catalog, self._part = catalog, (part, parts)

    def __getattr__(self, relation: str) -> DataFrame:
        if relation not in RELATION_SCHEMAS:
            raise AttributeError(relation)
        rows = getattr(self._catalog, relation)
        # By the name alone: a condition on one column reaches the scans also below joins.
        return rows.where(in_part("table_name", *self._part)) if "table_name" in RELATION_SCHEMAS[relation].fieldNames() else rows


def part_of(catalog: Catalog, part: int, parts: int) -> Catalog:
    """One of `parts` parts of a catalog's tables, as the catalog makes them itself (`part`) or by their names."""
    if parts == 1:
        return catalog
    return catalog.part(part, parts) if hasattr(catalog, "part") else TablePart(catalog, part, parts)


def read_parquet_catalog(spark: SparkSession, root: str) -> Catalog:
    """Read `<root>/<relation>` as Parquet with the declared schemas (no inference, no footer merging). A catalog stored by table
    (`bucketed.write_bucketed_catalog`) is read with its layout."""
    from lodestone.sources import bucketed  # which reads this module's layouts

    if bucketed.is_bucketed(spark, root):
        return bucketed.read_bucketed_catalog(spark, root)
    return catalog_from(
        {name: spark.read.schema(schema).parquet(f"{root}/{name}") for name, schema in RELATION_SCHEMAS.items()}
    )


def write_parquet_catalog(catalog: Catalog, root: str) -> None:
    """Store every relation as a Parquet snapshot that `read_parquet_catalog` reads back."""
    for name in RELATION_SCHEMAS:
        getattr(catalog, name).write.mode("overwrite").parquet(f"{root}/{name}")


# ---- database connector -------------------------------------------------------------------------------------

# Connector defaults.
JDBC_URL = "jdbc:mysql://{host}:{port}/"
CONNECT_TIMEOUT_SECONDS = 5
REQUIRED_SETTINGS = ("username", "password", "host", "port")


def jdbc_options(settings: dict[str, str], fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options for one server: no default database, short connect timeout, full Unicode."""
    missing = [key for key in REQUIRED_SETTINGS if not settings.get(key)]
    if missing:
        raise ValueError(f"missing connection settings: {', '.join(missing)}")
    return {
        "url": JDBC_URL.format(host=settings["host"], port=settings["port"]),
        "user": settings["username"],
        "password": settings["password"],
        "connectTimeout": str(CONNECT_TIMEOUT_SECONDS * 1000),
        "characterEncoding": "UTF-8",
        "fetchsize": str(fetch_size),
    }


def schema_predicates(schemas: Iterable[str], column: str = "TABLE_SCHEMA") -> list[str]:
    """One JDBC partition per schema, so that a large relation is read by many tasks."""
    return ["{} = '{}'".format(column, name.replace("'", "''")) for name in schemas]


def read_jdbc_relation(
    spark: SparkSession,
    relation: str,
    connection_qn: str,
    settings: dict[str, str],
    schemas: Iterable[str] | None = None,
) -> DataFrame:
    """Read one information_schema relation of one server, tagged with its connection."""
    schema = RELATION_SCHEMAS[relation]
    options = jdbc_options(settings)
    table = f"information_schema.{relation.upper()}"
    if schemas is None:
        rows = spark.read.format("jdbc").options(dbtable=table, **options).load()
    else:
        column = {"schemata": "SCHEMA_NAME", "routines": "ROUTINE_SCHEMA"}.get(relation, "TABLE_SCHEMA")
        url = options.pop("url")
        rows = spark.read.jdbc(url, table, predicates=schema_predicates(schemas, column), properties=options)
    return rows.select(
        F.lit(connection_qn).alias("connection_qn"),
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name != "connection_qn"),
    )

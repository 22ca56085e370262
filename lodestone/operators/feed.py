"""Input for the lineage parser: the SQL text of views and routines with the names needed to resolve it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.dialect import MYSQL, Dialect
from lodestone.operators.entities import PROCEDURE, VIEW

# Where the parser finds its input inside an entity line.
FEED_JSON_SCHEMA = (
    "typeName string, attributes struct<qualifiedName: string, connectionQualifiedName: string, "
    "definition: string, databaseName: string, schemaName: string>, "
    "defaultCatalogName string, defaultSchemaName string"
)


def _feed(df: DataFrame, vendor: str) -> DataFrame:
    sql = F.col("attributes.definition")
    return df.where(F.col("typeName").isin(VIEW, PROCEDURE) & (F.length(sql) > 0)).select(
        F.col("attributes.connectionQualifiedName").alias("connection_qn"),
        F.col("typeName").alias("type_name"),
        F.col("attributes.qualifiedName").alias("qualified_name"),
        sql.alias("sql"),
        F.col("attributes.databaseName").alias("catalog"),
        F.col("attributes.schemaName").alias("schema"),
        F.lit(vendor).alias("vendor"),
        F.col("defaultCatalogName").alias("default_catalog"),
        F.col("defaultSchemaName").alias("default_schema"),
    )


def lineage_parse_feed(tables: DataFrame, procedures: DataFrame, dialect: Dialect = MYSQL) -> DataFrame:
    """Feed straight from the entity DataFrames (`tables` holds tables and views)."""
    null = F.lit(None).cast("string")
    routines = procedures.select("*", null.alias("defaultCatalogName"), null.alias("defaultSchemaName"))
    return _feed(tables, dialect.vendor).unionByName(_feed(routines, dialect.vendor))


def lineage_parse_feed_from_json(lines: DataFrame, column: str = "value", dialect: Dialect = MYSQL) -> DataFrame:
    """Feed from delivered entity lines; a parsed line yields its feed fields only."""
    parsed = lines.select(F.from_json(column, FEED_JSON_SCHEMA).alias("e")).select("e.*")
    return _feed(parsed, dialect.vendor)

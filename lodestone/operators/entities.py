"""Entities: the nested records made from the extracts, and their JSON form.

Every entity DataFrame has the columns connection_qn, typeName, status, attributes. Tables, views and columns add
customAttributes; tables and views share one DataFrame (and one output stream) and add defaultCatalogName and
defaultSchemaName, filled for views only. An attribute that must be absent is NULL, and the JSON form drops it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.dialect import FOREIGN_KEY, MYSQL, PRIMARY_KEY, Dialect
from lodestone.functions.names import connector_of, path, procedure_path
from lodestone.functions.values import (
    coerce_numeric,
    col_or,
    epoch_ms,
    finite_or_null,
    first_present,
    flag,
    safe_str,
    text_or_empty,
    truthy,
    when_set,
    whole_or,
)

# Type names, status and reference names that consumers of the entities expect.
DATABASE, SCHEMA, TABLE, VIEW, COLUMN, PROCEDURE = "Database", "Schema", "Table", "View", "Column", "Procedure"
ACTIVE = "ACTIVE"
DEFAULT_TENANT = "default"
DATABASE_REF = "database"
SCHEMA_REF = "atlanSchema"
TABLE_REF = "table"
VIEW_REF = "view"
TABLE_SUBTYPE = "TABLE"
# Keys of the custom attributes.
TABLE_CUSTOM = ("engine", "version", "row_format", "data_length", "table_collation", "create_options")
COLUMN_CUSTOM = (
    "ordinal_position", "is_self_referencing", "numeric_precision", "is_auto_increment", "is_generated",
    "extra_info", "character_set_name", "collation_name", "column_type", "column_key", "privileges",
    "generation_expression", "is_autoincrement", "is_generatedcolumn", "constraint_type", "constraint_name",
    "buffer_length", "column_size", "is_identity", "identity_cycle", "character_octet_length",
)
# Of these, the keys that stay null, and the numeric ones that are written as '' when unknown.
COLUMN_CUSTOM_NULL = ("ordinal_position", "numeric_precision", "column_size")
COLUMN_CUSTOM_NUMBER_OR_EMPTY = ("buffer_length", "character_octet_length")


@dataclass(frozen=True)
class Stamp:
    """What every entity of a run carries. `connection_name` is left out while it is not known; with several
    connections it may be a Column made from `connection_qn`."""

    tenant_id: str = DEFAULT_TENANT
    connection_name: str | Column | None = None
    dialect: Dialect = MYSQL


PLAIN = Stamp()


def _ref(type_name: Column | str, qualified_name: Column) -> Column:
    type_name = F.lit(type_name) if isinstance(type_name, str) else type_name
    return F.struct(type_name.alias("typeName"), F.struct(qualified_name.alias("qualifiedName")).alias("uniqueAttributes"))


def _optional_ref(condition: Column, type_name: str, qualified_name: Column) -> Column:
    return F.when(condition, _ref(type_name, qualified_name))


def _attributes(stamp: Stamp, name: Column, qualified_name: Column, **own: Column) -> Column:
    connection = F.col("connection_qn")
    shared = {
        "name": name,
        "qualifiedName": qualified_name,
        "connectionQualifiedName": connection,
        "connectorName": connector_of(connection),
        "connectionName": F.lit(stamp.connection_name).cast("string"),
        "tenantId": F.lit(stamp.tenant_id),
    }
    return F.struct(*(value.alias(key) for key, value in {**shared, **own}.items()))


# Columns of an extract that hold attributes made in a way of a server family's own; they replace the mapper's.
OWN_ATTRIBUTES, OWN_CUSTOM = "_own_attributes", "_own_custom"


def _replaced(df: DataFrame, value: Column, own: str) -> Column:
    if own in df.columns:
        for name in df.schema[own].dataType.fieldNames():
            value = value.withField(name, F.col(own)[name])
    return value


def _entity(df: DataFrame, type_name: Column | str, attributes: Column, **extra: Column) -> DataFrame:
    type_name = F.lit(type_name) if isinstance(type_name, str) else type_name
    attributes = _replaced(df, attributes, OWN_ATTRIBUTES)
    if "customAttributes" in extra:
        extra["customAttributes"] = _replaced(df, extra["customAttributes"], OWN_CUSTOM)
    return df.select(
        "connection_qn",
        type_name.alias("typeName"),
        F.lit(ACTIVE).alias("status"),
        attributes.alias("attributes"),
        *(value.alias(key) for key, value in extra.items()),
    )


@dataclass(frozen=True)
class _Place:
    """Where an object sits: names and qualified names of its database and schema."""

    database: Column
    schema: Column

    @property
    def database_qn(self) -> Column:
        return path(F.col("connection_qn"), self.database)

    @property
    def schema_qn(self) -> Column:
        return path(self.database_qn, self.schema)

    def attributes(self) -> dict[str, Column]:
        return {
            "databaseName": self.database,
            "databaseQualifiedName": self.database_qn,
            "schemaName": self.schema,
            "schemaQualifiedName": self.schema_qn,
        }


def _place(df: DataFrame, catalog: tuple[str, ...], schema: tuple[str, ...], dialect: Dialect) -> _Place:
    return _Place(col_or(df, catalog, dialect.default_catalog), col_or(df, schema, ""))


def database_entities(df: DataFrame, stamp: Stamp = PLAIN) -> DataFrame:
    name = col_or(df, ("database_name", "datname"), "")
    attributes = _attributes(
        stamp, name, path(F.col("connection_qn"), name), schemaCount=whole_or(df, "schema_count", 0)
    )
    return _entity(df, DATABASE, attributes)


def schema_entities(df: DataFrame, stamp: Stamp = PLAIN) -> DataFrame:
    place = _place(df, ("catalog_name", "database_name", "datname"), ("schema_name",), stamp.dialect)
    attributes = _attributes(
        stamp,
        place.schema,
        place.schema_qn,
        databaseName=place.database,
        databaseQualifiedName=place.database_qn,
        tableCount=whole_or(df, "table_count", 0),
        viewsCount=whole_or(df, "views_count", 0),
        **{DATABASE_REF: _ref(DATABASE, place.database_qn)},
    )
    return _entity(df, SCHEMA, attributes)


def table_entities(df: DataFrame, stamp: Stamp = PLAIN) -> DataFrame:
    """Tables and views in one pass; `typeName` tells them apart."""
    place = _place(df, ("table_catalog", "database_name", "datname"), ("table_schema", "schema_name"), stamp.dialect)
    name = col_or(df, "table_name", "")
    kind = F.upper(col_or(df, ("table_kind", "table_type"), "BASE TABLE"))
    is_view = F.coalesce(kind.isin(*stamp.dialect.view_kinds), F.lit(False))

    def table_only(value: Column) -> Column:
        return F.when(~is_view, value)

    body = text_or_empty(col_or(df, "view_definition", ""))
    definition = F.when(
        F.length(body) > 0, F.concat(F.lit("CREATE OR REPLACE VIEW "), name, F.lit(" AS "), body)
    ).otherwise("")
    attributes = _attributes(
        stamp,
        name,
        path(place.schema_qn, name),
        **place.attributes(),
        description=text_or_empty(col_or(df, "remarks", "")),
        columnCount=whole_or(df, "column_count", 0),
        sizeBytes=whole_or(df, "size_bytes", 0),
        rowCount=table_only(whole_or(df, "row_count", 0)),
        subType=table_only(F.lit(TABLE_SUBTYPE)),
        isPartitioned=table_only(truthy(col_or(df, "is_partition", False))),
        partitionCount=table_only(whole_or(df, "partition_count", 0)),
        definition=F.when(is_view, definition),
        sourceCreatedAt=when_set(epoch_ms(df, "create_time")),
        **{SCHEMA_REF: _ref(SCHEMA, place.schema_qn)},
    )
    custom = F.struct(
        *(safe_str(df, key).alias(key) for key in TABLE_CUSTOM),
        F.lit("").alias("is_transient"),
    )
    return _entity(
        df,
        F.when(is_view, VIEW).otherwise(TABLE),
        attributes,
        customAttributes=custom,
        defaultCatalogName=F.when(is_view, place.database),
        defaultSchemaName=F.when(is_view, place.schema),
    )


def column_entities(df: DataFrame, stamp: Stamp = PLAIN) -> DataFrame:
    """Columns, each pointing at its table or its view, never at both."""
    place = _place(df, ("table_catalog", "database_name", "datname"), ("table_schema", "schema_name"), stamp.dialect)
    name = col_or(df, "column_name", "")
    parent = col_or(df, "table_name", "")
    parent_qn = path(place.schema_qn, parent)
    kind = F.upper(col_or(df, "table_type", "BASE TABLE"))
    in_view = F.coalesce(kind.isin(*stamp.dialect.view_kinds), F.lit(False))
    constraint = col_or(df, "constraint_type", "")
    data_type = text_or_empty(col_or(df, "data_type", ""))
    attributes = _attributes(
        stamp,
        name,
        path(parent_qn, name),
        **place.attributes(),
        tableName=F.when(~in_view, parent),
        tableQualifiedName=F.when(~in_view, parent_qn),
        viewName=F.when(in_view, parent),
        viewQualifiedName=F.when(in_view, parent_qn),
        dataType=F.upper(data_type),
        description=text_or_empty(col_or(df, "remarks", "")),
        isNullable=flag(col_or(df, "is_nullable", "YES"), "YES"),
        isPartition=F.lit(False),
        isPrimary=flag(constraint, PRIMARY_KEY),
        isForeign=flag(constraint, FOREIGN_KEY),
        maxLength=coerce_numeric(df, ("max_length", "character_maximum_length")),
        numericScale=coerce_numeric(df, ("numeric_scale", "decimal_digits")),
        precision=coerce_numeric(df, "numeric_precision").cast("bigint"),
        order=whole_or(df, "ordinal_position", 0),
        **{TABLE_REF: _optional_ref(~in_view, TABLE, parent_qn), VIEW_REF: _optional_ref(in_view, VIEW, parent_qn)},
    )

    def custom_value(key: str) -> Column:
        if first_present(df, key) is None:
            kept_null = key in COLUMN_CUSTOM_NULL + COLUMN_CUSTOM_NUMBER_OR_EMPTY
            return F.lit(None).cast("bigint") if kept_null else F.lit("")
        value = finite_or_null(df, key)
        if key in COLUMN_CUSTOM_NULL + COLUMN_CUSTOM_NUMBER_OR_EMPTY:
            return value
        return text_or_empty(value)

    custom = F.struct(
        *(custom_value(key).alias(key) for key in COLUMN_CUSTOM),
        F.lower(data_type).alias("type_name"),
    )
    return _entity(df, COLUMN, attributes, customAttributes=custom)


def procedure_entities(df: DataFrame, stamp: Stamp = PLAIN) -> DataFrame:
    place = _place(df, ("procedure_catalog",), ("procedure_schema",), stamp.dialect)
    name = col_or(df, "procedure_name", "")
    attributes = _attributes(
        stamp,
        name,
        procedure_path(place.schema_qn, name),
        **place.attributes(),
        definition=text_or_empty(col_or(df, "procedure_definition", "")),
        subType=col_or(df, "procedure_type", "PROCEDURE"),
        description=text_or_empty(col_or(df, "remarks", "")),
        sourceCreatedBy=F.nullif(text_or_empty(col_or(df, "source_owner", "")), F.lit("")),
        sourceCreatedAt=when_set(epoch_ms(df, "created")),
        sourceUpdatedAt=when_set(epoch_ms(df, "last_altered")),
        **{SCHEMA_REF: _ref(SCHEMA, place.schema_qn)},
    )
    return _entity(df, PROCEDURE, attributes)


# ---- JSON form ----------------------------------------------------------------------------------------------


# Types whose values read the same as a field of their own and as a variant.
_SAME_AS_VARIANT = (T.IntegralType, T.StringType, T.BooleanType)


def _custom(df: DataFrame) -> Column | None:
    """Custom attributes whose nulls are values, so that they are written where absent ones are left out; an unknown length is the
    empty text, a known one a number. None if a field that may be null is of a type that has no such form."""
    fields = []
    for field in df.schema["customAttributes"].dataType.fields:
        value = F.col("customAttributes")[field.name]
        if field.name in COLUMN_CUSTOM_NUMBER_OR_EMPTY:
            value = F.when(value.isNotNull(), value.cast("variant")).otherwise(F.lit("").cast("variant"))
        elif field.nullable:
            if not isinstance(field.dataType, _SAME_AS_VARIANT):
                return None
            value = F.coalesce(value.cast("variant"), F.parse_json(F.lit("null")))
        fields.append(value.alias(field.name))
    return F.struct(*fields)


def _custom_json(df: DataFrame) -> Column:
    """Custom attributes keep their nulls; an unknown length is the empty text, a known one a number."""
    custom = F.col("customAttributes")
    names = df.schema["customAttributes"].dataType.fieldNames()
    for key in COLUMN_CUSTOM_NUMBER_OR_EMPTY:
        if key in names:
            number = custom[key].cast("variant")
            custom = custom.withField(key, F.when(custom[key].isNotNull(), number).otherwise(F.lit("").cast("variant")))
    return F.to_json(custom, {"ignoreNullFields": "false"})


def entity_json(df: DataFrame) -> Column:
    """One JSON object per entity: absent attributes are left out, references sit inside `attributes`."""
    envelope = [F.col(c) for c in ("typeName", "status", "attributes")]
    envelope += [F.col(c) for c in ("defaultCatalogName", "defaultSchemaName") if c in df.columns]
    custom = _custom(df) if "customAttributes" in df.columns else None
    if custom is not None:
        # One serialisation, of which no text is cut or joined.
        return F.to_json(F.struct(*envelope, custom.alias("customAttributes")))
    head = F.to_json(F.struct(*envelope))
    if "customAttributes" not in df.columns:
        return head
    # The head is named once, so it is serialised once; its closing brace makes room for the custom attributes.
    return F.concat(F.regexp_replace(head, r"\}\z", ',"customAttributes":'), _custom_json(df), F.lit("}"))

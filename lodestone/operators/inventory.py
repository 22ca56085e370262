"""The extracts: one DataFrame per kind of source object, in a fixed layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.dialect import MYSQL, Dialect
from lodestone.operators.constraints import COLUMN_KEY, constraint_roles
from lodestone.operators.filters import KEEP_ALL, CatalogFilter, hidden_in_picker, keep, kept_type, not_system
from lodestone.operators.projection import project
from lodestone.sources.catalog import RELATION_SCHEMAS, Catalog

TABLE_KEY = ("connection_qn", "table_schema", "table_name")

# Output layouts of the extracts.
DATABASE_LAYOUT = ("database_name", "datname", "schema_count")
SCHEMA_LAYOUT = ("catalog_name", "schema_name", "schema_owner", "table_count", "views_count")
TABLE_LAYOUT = (
    "table_catalog", "table_schema", "table_name", "row_count", "column_count", "table_kind", "table_type",
    "is_partition", "partition_strategy", "partition_count", "parent_table_name", "partitioned_parent_table",
    "partition_constraint", "number_columns_in_part_key", "columns_participating_in_part_key", "view_definition",
    "self_referencing_column_name", "reference_generation", "user_defined_type_catalog",
    "user_defined_type_schema", "user_defined_type_name", "is_insertable_into", "is_typed", "commit_action",
    "remarks", "size_bytes", "location", "file_format_type", "stage_region", "engine", "ref_generation",
    "version", "row_format", "data_length", "auto_increment", "table_collation", "create_options",
    "create_time", "partitions",
)
TABLE_NEVER_FILLED = (
    "partitioned_parent_table", "partition_constraint", "columns_participating_in_part_key",
    "self_referencing_column_name", "reference_generation", "user_defined_type_catalog",
    "user_defined_type_schema", "user_defined_type_name", "commit_action", "location", "file_format_type",
    "stage_region", "ref_generation",
)
COLUMN_LAYOUT = (
    "table_catalog", "table_schema", "table_name", "column_name", "ordinal_position", "column_def",
    "is_nullable", "data_type", "is_auto_increment", "numeric_precision", "character_octet_length",
    "buffer_length", "is_generated", "is_generatedcolumn", "is_identity", "identity_cycle", "column_size",
    "num_prec_radix", "decimal_digits", "table_type", "belongs_to_partition", "partitioned_table",
    "constraint_type", "constraint_name", "remarks", "partition_order", "is_partition", "numeric_scale",
    "max_length", "is_self_referencing", "extra_info", "character_set_name", "collation_name", "column_type",
    "column_key", "privileges", "generation_expression", "is_autoincrement",
)
COLUMN_NEVER_FILLED = ("identity_cycle", "partition_order", "is_partition", "is_self_referencing")
PROCEDURE_LAYOUT = (
    "procedure_catalog", "procedure_schema", "procedure_name", "source_owner", "procedure_definition",
    "procedure_type", "remarks", "created", "last_altered",
)


def _yes_no(condition: Column) -> Column:
    return F.when(condition, "YES").otherwise("NO")


def database_inventory(catalog: Catalog, dialect: Dialect = MYSQL) -> DataFrame:
    """One row per connection with its number of non-system schemas, also when that is 0."""
    counts = (
        catalog.schemata.where(not_system(F.col("schema_name"), dialect))
        .groupBy("connection_qn")
        .agg(F.count("*").alias("n"))
    )
    name = F.lit(dialect.default_catalog)
    return project(
        catalog.connections.join(counts, "connection_qn", "left"),
        DATABASE_LAYOUT,
        {"database_name": name, "datname": name, "schema_count": F.coalesce("n", F.lit(0))},
    )


def schema_inventory(
    catalog: Catalog, rules: CatalogFilter = KEEP_ALL, dialect: Dialect = MYSQL, ordered: bool = False
) -> DataFrame:
    """Schemas with their table and view counts; the counts ignore the table-name filter. `ordered` sorts by name."""
    table_type = F.col("table_type")
    counts = catalog.tables.groupBy("connection_qn", F.col("table_schema").alias("schema_name")).agg(
        F.count_if(table_type.isin(*dialect.table_count_types)).alias("n_tables"),
        F.count_if(table_type == dialect.view_count_type).alias("n_views"),
    )
    schemas = keep(catalog.schemata, "schema_name", rules, dialect)
    result = project(
        schemas.join(counts, ["connection_qn", "schema_name"], "left"),
        SCHEMA_LAYOUT,
        {
            "catalog_name": F.lit(dialect.default_catalog),
            "schema_name": F.col("schema_name"),
            "schema_owner": F.lit(dialect.schema_owner),
            "table_count": F.coalesce("n_tables", F.lit(0)),
            "views_count": F.coalesce("n_views", F.lit(0)),
        },
    )
    return result.orderBy("schema_name") if ordered else result


def schema_picker(catalog: Catalog, dialect: Dialect = MYSQL) -> DataFrame:
    """Schemas a user may choose from; the run's include and exclude patterns do not apply here."""
    return catalog.schemata.where(
        not_system(F.col("schema_name"), dialect) & ~hidden_in_picker(F.col("schema_name"))
    ).select("connection_qn", F.lit(dialect.default_catalog).alias("catalog_name"), "schema_name")


def accessible_tables(catalog: Catalog, rules: CatalogFilter = KEEP_ALL, dialect: Dialect = MYSQL) -> DataFrame:
    """The source rows of the tables and views that are catalogued."""
    return keep(catalog.tables, "table_schema", rules, dialect, table="table_name").where(
        kept_type(F.col("table_type"), dialect)
    )


def accessible_table_count(
    catalog: Catalog, rules: CatalogFilter = KEEP_ALL, dialect: Dialect = MYSQL
) -> DataFrame:
    """Number of catalogued tables per connection, also when it is 0."""
    counts = accessible_tables(catalog, rules, dialect).groupBy("connection_qn").agg(F.count("*").alias("n"))
    return catalog.connections.join(counts, "connection_qn", "left").select(
        "connection_qn", F.coalesce("n", F.lit(0)).alias("count")
    )


def tables_per_schema(catalog: Catalog, dialect: Dialect = MYSQL) -> DataFrame:
    """Number of source table rows of any kind per non-system schema."""
    return (
        catalog.tables.where(not_system(F.col("table_schema"), dialect))
        .groupBy("connection_qn", "table_schema")
        .agg(F.count("*").alias("table_count"))
    )


def partition_summary(catalog: Catalog, dialect: Dialect = MYSQL) -> DataFrame:
    """Partition count and ordered name list per table and partition method.

    Names repeat (subpartitions) and every repeat counts. Repeats are counted before anything is gathered, so a
    group holds each distinct name once; the list is only written out at the end.
    """
    per_name = (
        catalog.partitions.where(not_system(F.col("table_schema"), dialect))
        .groupBy(*TABLE_KEY, "partition_method", "partition_name")
        .agg(F.count("*").alias("n"))
    )
    named = F.when(F.col("partition_name").isNotNull(), F.struct(F.col("partition_name").alias("name"), "n"))
    grouped = per_name.groupBy(*TABLE_KEY, "partition_method").agg(
        F.sum("n").alias("partition_count"), F.sort_array(F.collect_list(named)).alias("names")
    )
    listed = F.array_join(
        F.transform(
            "names", lambda x: F.concat(F.repeat(F.concat(x["name"], F.lit(",")), (x["n"] - 1).cast("int")), x["name"])
        ),
        ",",
    )
    return grouped.select(
        *TABLE_KEY,
        "partition_method",
        "partition_count",
        F.when(F.size("names") > 0, listed).alias("partitions"),
    )


def column_counts(catalog: Catalog, dialect: Dialect = MYSQL) -> DataFrame:
    """Number of source column rows per table, before any filter on tables."""
    return (
        catalog.columns.where(not_system(F.col("table_schema"), dialect))
        .groupBy(*TABLE_KEY)
        .agg(F.count("*").alias("n_columns"))
    )


def table_inventory(catalog: Catalog, rules: CatalogFilter = KEEP_ALL, dialect: Dialect = MYSQL) -> DataFrame:
    """Tables and views with column counts, partitions, size and view text.

    Every right side is reduced to at most one row per table (and partition method) before its join, and all joins
    use the same key.
    """
    # The longest texts here, so they are shuffled once: reduced by the key of the join that follows.
    views = keep(catalog.views, "table_schema", rules, dialect, table="table_name")
    views = views.groupBy(*TABLE_KEY).agg(F.max("view_definition").alias("view_definition"))
    joined = (
        accessible_tables(catalog, rules, dialect)
        .join(column_counts(catalog, dialect), list(TABLE_KEY), "left")
        .join(partition_summary(catalog, dialect), list(TABLE_KEY), "left")
        .join(views, list(TABLE_KEY), "left")
    )
    partitioned = F.col("partition_method").isNotNull()
    return project(
        joined,
        TABLE_LAYOUT,
        {
            "table_catalog": F.col("table_catalog"),
            "table_schema": F.col("table_schema"),
            "table_name": F.col("table_name"),
            "row_count": F.coalesce("table_rows", F.lit(0)),
            "column_count": F.coalesce("n_columns", F.lit(0)),
            "table_kind": F.col("table_type"),
            "table_type": F.col("table_type"),
            "is_partition": partitioned,
            "partition_strategy": F.col("partition_method"),
            "partition_count": F.when(partitioned, F.col("partition_count")).otherwise(0),
            "parent_table_name": F.col("table_name"),
            "number_columns_in_part_key": F.lit(0),
            "view_definition": F.col("view_definition"),
            # The source marks views, not tables, as insertable; kept as it is.
            "is_insertable_into": _yes_no(F.col("table_type") == dialect.view_count_type),
            "is_typed": F.lit("NO"),
            "remarks": F.col("table_comment"),
            # One unknown length makes the whole size unknown, hence 0.
            "size_bytes": F.coalesce(F.col("data_length") + F.col("index_length"), F.lit(0)),
            "engine": F.col("engine"),
            "version": F.col("version"),
            "row_format": F.col("row_format"),
            "data_length": F.col("data_length"),
            "auto_increment": F.col("auto_increment"),
            "table_collation": F.col("table_collation"),
            "create_options": F.col("create_options"),
            "create_time": F.col("create_time"),
            "partitions": F.col("partitions"),
        },
        TABLE_NEVER_FILLED,
    )


def table_kinds(catalog: Catalog, rules: CatalogFilter = KEEP_ALL, dialect: Dialect = MYSQL) -> DataFrame:
    """The kind of every catalogued table, once, however often the source repeats the table.

    Distinct over table and kind, so that a join by table shuffles this side itself: only a join whose two inputs
    both come straight from a shuffle can have its hot partitions split at run time.
    """
    return accessible_tables(catalog, rules, dialect).select(*TABLE_KEY, "table_type").distinct()


def column_inventory(
    catalog: Catalog, rules: CatalogFilter = KEEP_ALL, dialect: Dialect = MYSQL, ordered: bool = False
) -> DataFrame:
    """Columns of the catalogued tables and views, with key roles.

    The large side is shuffled twice: by table, for the join to the table kinds and the removal of repeated rows,
    and by column, for the join to the key roles. Where one table (or one much repeated row) is so hot that its
    partition is split at run time, Spark shuffles once more to remove repeats, combining them before that shuffle.
    Repeats are removed on what the outputs show of the source row (of the length, only the two outputs made from it),
    with the table kind; the key role is a function of these. Both joined sides have at most one row per key and kind, so
    the joins never multiply rows.
    `ordered` asks for a global order by schema, table and position.
    """
    columns = keep(catalog.columns, "table_schema", rules, dialect, table="table_name")
    columns = columns.select(
        *(c for c in RELATION_SCHEMAS["columns"].fieldNames() if c != "character_maximum_length"),
        F.coalesce("character_maximum_length", "numeric_precision").alias("column_size"),
        F.coalesce("character_maximum_length", F.lit(0)).alias("max_length"),
    )
    joined = (
        columns.join(table_kinds(catalog, rules, dialect), list(TABLE_KEY))
        .distinct()
        .join(constraint_roles(catalog), list(COLUMN_KEY), "left")
    )
    auto_increment = _yes_no(F.col("extra").contains("auto_increment"))
    expression = F.col("generation_expression")
    result = project(
        joined,
        COLUMN_LAYOUT,
        {
            "table_catalog": F.col("table_catalog"),
            "table_schema": F.col("table_schema"),
            "table_name": F.col("table_name"),
            "column_name": F.col("column_name"),
            "ordinal_position": F.col("ordinal_position"),
            "column_def": F.col("column_default"),
            "is_nullable": F.col("is_nullable"),
            "data_type": F.col("data_type"),
            "is_auto_increment": auto_increment,
            "numeric_precision": F.col("numeric_precision"),
            "character_octet_length": F.col("character_octet_length"),
            "buffer_length": F.col("character_octet_length"),
            # An empty expression counts as generated here, but not in the next column; kept as it is.
            "is_generated": _yes_no(expression.isNotNull()),
            "is_generatedcolumn": _yes_no(expression.isNotNull() & (expression != "")),
            "is_identity": F.lit("NO"),
            "column_size": F.col("column_size"),
            # The source reports the scale under this name; kept as it is.
            "num_prec_radix": F.col("numeric_scale"),
            "decimal_digits": F.col("numeric_scale"),
            "table_type": F.col("table_type"),
            "belongs_to_partition": F.lit("NO"),
            "partitioned_table": F.lit("NO"),
            "constraint_type": F.col("constraint_type"),
            "constraint_name": F.col("constraint_name"),
            "remarks": F.col("column_comment"),
            "numeric_scale": F.col("numeric_scale"),
            "max_length": F.col("max_length"),
            "extra_info": F.col("extra"),
            "character_set_name": F.col("character_set_name"),
            "collation_name": F.col("collation_name"),
            "column_type": F.col("column_type"),
            "column_key": F.col("column_key"),
            "privileges": F.col("privileges"),
            "generation_expression": expression,
            "is_autoincrement": auto_increment,
        },
        COLUMN_NEVER_FILLED,
    )
    return result.orderBy("table_schema", "table_name", "ordinal_position") if ordered else result


def routine_inventory(catalog: Catalog, rules: CatalogFilter = KEEP_ALL, dialect: Dialect = MYSQL) -> DataFrame:
    """Stored procedures and functions."""
    return project(
        keep(catalog.routines, "routine_schema", rules, dialect),
        PROCEDURE_LAYOUT,
        {
            "procedure_catalog": F.lit(dialect.default_catalog),
            "procedure_schema": F.col("routine_schema"),
            "procedure_name": F.col("routine_name"),
            "source_owner": F.col("definer"),
            "procedure_definition": F.col("routine_definition"),
            "procedure_type": F.col("routine_type"),
            "remarks": F.col("routine_comment"),
            "created": F.col("created"),
            "last_altered": F.col("last_altered"),
        },
    )

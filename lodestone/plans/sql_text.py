"""Extracts as SQL text that a user may change: relations by name, values as parameters, optional predicates from a fixed choice."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.dialect import MYSQL, Dialect
from lodestone.operators import inventory as I
from lodestone.operators.filters import EXCLUDE_NONE, INCLUDE_ALL, KEEP_ALL, CatalogFilter
from lodestone.sources.catalog import RELATION_SCHEMAS, Catalog


class SqlTextError(ValueError):
    """A text names a relation, slot, choice or parameter that is not there."""


def _place(column: str) -> str:
    return f"regexp_like(concat(:current_database, '.', {column}), :include) AND NOT regexp_like(concat(:current_database, '.', {column}), :exclude)"


# What may stand in a text's slots: for each slot its choices. Values come in by parameters only.
FRAGMENTS: dict[str, dict[str, str]] = {
    "schemas_wanted": {"all": "", "by_rules": f"AND {_place('schema_name')}"},
    "tables_of_wanted_schemas": {"all": "", "by_rules": f"AND {_place('table_schema')}"},
    "routines_of_wanted_schemas": {"all": "", "by_rules": f"AND {_place('routine_schema')}"},
    "without_excluded_tables": {"all": "", "by_rules": "AND NOT regexp_like(table_name, :exclude_table)"},
}

_KEPT = """NOT array_contains(:system_schemas, lower(table_schema)) {tables_of_wanted_schemas} {without_excluded_tables}"""

DATABASE = """
SELECT c.connection_qn, :catalog AS database_name, :catalog AS datname, coalesce(s.n, 0) AS schema_count
FROM {connections} c LEFT JOIN (
    SELECT connection_qn, count(*) AS n FROM {schemata} WHERE NOT array_contains(:system_schemas, lower(schema_name)) GROUP BY connection_qn
) s ON s.connection_qn = c.connection_qn"""

SCHEMA = """
SELECT s.connection_qn, :catalog AS catalog_name, s.schema_name, :schema_owner AS schema_owner,
    coalesce(t.table_count, 0) AS table_count, coalesce(t.views_count, 0) AS views_count
FROM (SELECT * FROM {schemata} WHERE NOT array_contains(:system_schemas, lower(schema_name)) {schemas_wanted}) s
LEFT JOIN (
    SELECT connection_qn, table_schema, count_if(array_contains(:table_count_types, table_type)) AS table_count,
        count_if(table_type = :view_count_type) AS views_count
    FROM {tables} GROUP BY connection_qn, table_schema
) t ON t.connection_qn = s.connection_qn AND t.table_schema = s.schema_name"""

TABLE = f"""
SELECT t.connection_qn, t.table_catalog, t.table_schema, t.table_name, coalesce(t.table_rows, 0) AS row_count, coalesce(c.column_count, 0) AS column_count,
    t.table_type AS table_kind, t.table_type, p.partition_method IS NOT NULL AS is_partition, p.partition_method AS partition_strategy,
    CASE WHEN p.partition_method IS NOT NULL THEN p.partition_count ELSE 0 END AS partition_count, t.table_name AS parent_table_name,
    0 AS number_columns_in_part_key, v.view_definition, CASE WHEN t.table_type = :view_count_type THEN 'YES' ELSE 'NO' END AS is_insertable_into,
    'NO' AS is_typed, t.table_comment AS remarks, coalesce(t.data_length + t.index_length, 0) AS size_bytes, t.engine, t.version, t.row_format,
    t.data_length, t.auto_increment, t.table_collation, t.create_options, t.create_time, p.partitions
FROM (SELECT * FROM {{tables}} WHERE {_KEPT} AND array_contains(:kept_table_types, table_type)) t
LEFT JOIN (
    SELECT connection_qn, table_schema, table_name, count(*) AS column_count FROM {{columns}} GROUP BY connection_qn, table_schema, table_name
) c ON c.connection_qn = t.connection_qn AND c.table_schema = t.table_schema AND c.table_name = t.table_name
LEFT JOIN (
    SELECT connection_qn, table_schema, table_name, partition_method, sum(n) AS partition_count,
        CASE WHEN count(partition_name) > 0 THEN array_join(flatten(transform(
            sort_array(collect_list(CASE WHEN partition_name IS NOT NULL THEN struct(partition_name, n) END)),
            x -> array_repeat(x.partition_name, int(x.n)))), ',') END AS partitions
    FROM (
        SELECT connection_qn, table_schema, table_name, partition_method, partition_name, count(*) AS n
        FROM {{partitions}} GROUP BY connection_qn, table_schema, table_name, partition_method, partition_name
    ) GROUP BY connection_qn, table_schema, table_name, partition_method
) p ON p.connection_qn = t.connection_qn AND p.table_schema = t.table_schema AND p.table_name = t.table_name
LEFT JOIN (
    SELECT connection_qn, table_schema, table_name, max(view_definition) AS view_definition
    FROM {{views}} GROUP BY connection_qn, table_schema, table_name
) v ON v.connection_qn = t.connection_qn AND v.table_schema = t.table_schema AND v.table_name = t.table_name"""

COLUMN = f"""
SELECT c.connection_qn, c.table_catalog, c.table_schema, c.table_name, c.column_name, c.ordinal_position, c.column_default AS column_def,
    c.is_nullable, c.data_type, CASE WHEN c.extra LIKE '%auto\\_increment%' THEN 'YES' ELSE 'NO' END AS is_auto_increment, c.numeric_precision,
    c.character_octet_length, c.character_octet_length AS buffer_length,
    CASE WHEN c.generation_expression IS NOT NULL THEN 'YES' ELSE 'NO' END AS is_generated,
    CASE WHEN c.generation_expression <> '' THEN 'YES' ELSE 'NO' END AS is_generatedcolumn, 'NO' AS is_identity, c.column_size,
    c.numeric_scale AS num_prec_radix, c.numeric_scale AS decimal_digits, c.table_type, 'NO' AS belongs_to_partition, 'NO' AS partitioned_table,
    r.constraint_type, r.constraint_name, c.column_comment AS remarks, c.numeric_scale, c.max_length, c.extra AS extra_info,
    c.character_set_name, c.collation_name, c.column_type, c.column_key, c.privileges, c.generation_expression,
    CASE WHEN c.extra LIKE '%auto\\_increment%' THEN 'YES' ELSE 'NO' END AS is_autoincrement
FROM (
    SELECT DISTINCT k.* EXCEPT (character_maximum_length), t.table_type,
        coalesce(k.character_maximum_length, k.numeric_precision) AS column_size, coalesce(k.character_maximum_length, 0) AS max_length
    FROM (SELECT * FROM {{columns}} WHERE {_KEPT}) k
    JOIN (
        SELECT DISTINCT connection_qn, table_schema, table_name, table_type FROM {{tables}}
        WHERE {_KEPT} AND array_contains(:kept_table_types, table_type)
    ) t ON t.connection_qn = k.connection_qn AND t.table_schema = k.table_schema AND t.table_name = k.table_name
) c
LEFT JOIN (
    SELECT u.connection_qn, u.table_schema, u.table_name, u.column_name,
        CASE WHEN bool_or(k.is_pk) THEN 'PRIMARY KEY' ELSE 'FOREIGN KEY' END AS constraint_type,
        min(CASE WHEN k.is_pk THEN k.constraint_name END) AS constraint_name
    FROM {{key_column_usage}} u JOIN (
        SELECT DISTINCT connection_qn, constraint_schema, constraint_name, table_schema, table_name, constraint_type = 'PRIMARY KEY' AS is_pk
        FROM {{table_constraints}} WHERE constraint_type IN ('PRIMARY KEY', 'FOREIGN KEY')
    ) k ON k.connection_qn = u.connection_qn AND k.constraint_schema = u.constraint_schema AND k.constraint_name = u.constraint_name
        AND k.table_schema = u.table_schema AND k.table_name = u.table_name
    GROUP BY u.connection_qn, u.table_schema, u.table_name, u.column_name
) r ON r.connection_qn = c.connection_qn AND r.table_schema = c.table_schema AND r.table_name = c.table_name AND r.column_name = c.column_name"""

PROCEDURE = """
SELECT connection_qn, :catalog AS procedure_catalog, routine_schema AS procedure_schema, routine_name AS procedure_name, definer AS source_owner,
    routine_definition AS procedure_definition, routine_type AS procedure_type, routine_comment AS remarks, created, last_altered
FROM {routines} WHERE NOT array_contains(:system_schemas, lower(routine_schema)) {routines_of_wanted_schemas}"""

# Each extract's text and the columns it is brought to.
TEXTS: dict[str, tuple[str, Sequence[str]]] = {
    "database": (DATABASE, I.DATABASE_LAYOUT),
    "schema": (SCHEMA, I.SCHEMA_LAYOUT),
    "table": (TABLE, I.TABLE_LAYOUT),
    "column": (COLUMN, I.COLUMN_LAYOUT),
    "procedure": (PROCEDURE, I.PROCEDURE_LAYOUT),
}


def run_text(
    spark: SparkSession, catalog: Catalog, text: str, parameters: Mapping[str, Any] | None = None, slots: Mapping[str, str] | None = None
) -> DataFrame:
    """The rows of `text`, Spark SQL over the catalog.

    `{tables}` and the other relations' names stand for the relations, `{slot}` for the choice that `slots` makes among its
    `FRAGMENTS`, and `:name` for a parameter. Parameters are values and nothing else: Spark puts them into the parsed plan, so
    no quote in one can end a literal.
    """
    slots = slots or {}
    frames, parts = {}, {}
    for name in set(re.findall(r"\{(\w*)\}", text)):
        if name in RELATION_SCHEMAS:
            frames[name] = getattr(catalog, name)
        elif name in FRAGMENTS:
            choice = slots.get(name, "all")
            if choice not in FRAGMENTS[name]:
                raise SqlTextError(f"slot {name} has no choice {choice}; it has {', '.join(FRAGMENTS[name])}")
            parts[name] = FRAGMENTS[name][choice]
        else:
            raise SqlTextError(f"there is no relation or slot {{{name}}}")
    for name, part in parts.items():
        text = text.replace(f"{{{name}}}", part)
    wanted = set(re.findall(r"(?<![:\w]):([A-Za-z_]\w*)", text))
    given = {k: F.array(*map(F.lit, v)) if isinstance(v, (list, tuple)) else v for k, v in (parameters or {}).items() if k in wanted}
    if missing := wanted - given.keys():
        raise SqlTextError(f"no value for {', '.join(sorted(missing))}")
    return spark.sql(text, args=given, **frames)


def parameters_of(rules: CatalogFilter, dialect: Dialect = MYSQL) -> dict[str, Any]:
    """The parameters that texts may use, from a run's rules and the server family."""
    if rules.per_connection is not None or rules.case_sensitive:
        raise SqlTextError("texts take one set of rules that ignore case")
    return {
        "catalog": dialect.default_catalog,
        "current_database": rules.current_database or dialect.default_catalog,
        "include": rules._cased(rules.include or INCLUDE_ALL),
        "exclude": rules._cased(rules.exclude or EXCLUDE_NONE),
        "exclude_table": rules._cased(rules.exclude_table or EXCLUDE_NONE),
        "system_schemas": [s.lower() for s in dialect.system_schemas],
        "kept_table_types": list(dialect.kept_table_types),
        "table_count_types": list(dialect.table_count_types),
        "view_count_type": dialect.view_count_type,
        "schema_owner": dialect.schema_owner,
    }


def slots_of(rules: CatalogFilter) -> dict[str, str]:
    """The choices that a run's rules ask for; predicates that decide nothing are left out."""
    by_schema = "by_rules" if rules.include not in ("", INCLUDE_ALL) or rules.exclude not in ("", EXCLUDE_NONE) else "all"
    slots = dict.fromkeys(("schemas_wanted", "tables_of_wanted_schemas", "routines_of_wanted_schemas"), by_schema)
    return {**slots, "without_excluded_tables": "by_rules" if rules.exclude_table else "all"}


def text_extract(
    spark: SparkSession, catalog: Catalog, name: str, rules: CatalogFilter = KEEP_ALL, dialect: Dialect = MYSQL, text: str | None = None
) -> DataFrame:
    """One of the five extracts from its text, or from a user's in its place. Columns of the layout that the text doesn't give are NULL
    strings, others it gives come after, so that mappers find what they look for."""
    own, layout = TEXTS[name]
    rows = run_text(spark, catalog, text or own, parameters_of(rules, dialect), slots_of(rules))
    null: Column = F.lit(None).cast("string")
    there = set(rows.columns)
    if "connection_qn" not in there:
        raise SqlTextError("the text gives no connection_qn")
    more = [c for c in rows.columns if c not in layout and c != "connection_qn"]
    return rows.select("connection_qn", *(F.col(c) if c in there else null.alias(c) for c in layout), *more)

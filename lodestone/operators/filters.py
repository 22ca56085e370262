"""Which schemas and tables are catalogued."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.dialect import MYSQL, PICKER_HIDDEN_SCHEMAS, Dialect

# Patterns that include everything and exclude nothing.
INCLUDE_ALL = ".*"
EXCLUDE_NONE = "^$"
RULE_COLUMNS = ["connection_qn", "include_re", "exclude_re", "exclude_table_re"]


@dataclass(frozen=True)
class CatalogFilter:
    """Include and exclude patterns on `<catalog>.<schema>`, and an exclude pattern on table names.

    Patterns are searched, not anchored, and ignore case unless `case_sensitive` is set, which also governs how the server's
    own schemas are told. Exclude wins over include.
    An empty pattern counts as not given.
    `per_connection` is an optional DataFrame (connection_qn, include_re, exclude_re, exclude_table_re) whose
    non-NULL values replace the patterns given here for that connection. It is joined without a hint: Spark
    broadcasts it while it is small and shuffles it otherwise.
    """

    include: str = INCLUDE_ALL
    exclude: str = EXCLUDE_NONE
    exclude_table: str | None = None
    case_sensitive: bool = False
    current_database: str | None = None
    per_connection: DataFrame | None = None

    def matches(self, c: Column, pattern: str) -> Column:
        return c.rlike(self._cased(pattern))

    def _cased(self, pattern: str) -> str:
        return pattern if self.case_sensitive else f"(?iu){pattern}"

    def _cased_column(self, pattern: Column) -> Column:
        return pattern if self.case_sensitive else F.concat(F.lit("(?iu)"), pattern)


KEEP_ALL = CatalogFilter()


def connection_rules(
    spark: SparkSession, rules: Mapping[str, tuple[str | None, str | None, str | None]]
) -> DataFrame:
    """A `per_connection` DataFrame from {connection: (include, exclude, exclude_table)}.

    Made from an Arrow table, so that Spark knows its size and can broadcast it; rows from a Python list have none.
    """
    columns = list(zip(*((c, *r) for c, r in rules.items()), strict=True)) or [()] * 4
    return spark.createDataFrame(pa.table([pa.array(c, pa.string()) for c in columns], names=RULE_COLUMNS))


def not_system(schema: Column, dialect: Dialect = MYSQL, case_sensitive: bool = False) -> Column:
    """Schemas that are not the server's own. The plain comparison reaches the scan; the other ignores case, as patterns do."""
    named = ~schema.isin(*dialect.system_schemas)
    if case_sensitive:
        return named
    return named & ~F.lower(schema).isin(*(s.lower() for s in dialect.system_schemas))


def kept_type(table_type: Column, dialect: Dialect = MYSQL) -> Column:
    """The table kinds that are catalogued; tables, columns and the table count all use this one list."""
    return table_type.isin(*dialect.kept_table_types)


def schema_key(schema: Column, rules: CatalogFilter, dialect: Dialect = MYSQL) -> Column:
    """What the include and exclude patterns are matched against."""
    return F.concat(F.lit(rules.current_database or dialect.default_catalog), F.lit("."), schema)


def keep(
    df: DataFrame,
    schema: str,
    rules: CatalogFilter = KEEP_ALL,
    dialect: Dialect = MYSQL,
    table: str | None = None,
) -> DataFrame:
    """Rows whose schema is admitted; with `table`, also drops rows whose table name is excluded."""
    df = df.where(not_system(F.col(schema), dialect, rules.case_sensitive))
    key = schema_key(F.col(schema), rules, dialect)
    if rules.per_connection is not None:
        return _keep_per_connection(df, schema, key, rules, table)
    # The default patterns decide nothing (a schema key is never empty), so they cost nothing either.
    if rules.include in ("", INCLUDE_ALL):
        df = df.where(key.isNotNull())
    else:
        df = df.where(rules.matches(key, rules.include))
    if rules.exclude not in ("", EXCLUDE_NONE):
        df = df.where(~rules.matches(key, rules.exclude))
    if table and rules.exclude_table:
        df = df.where(~rules.matches(F.col(table), rules.exclude_table))
    return df


# So many different table patterns are compiled into the plan; of more, each is tried once for each different name.
LITERAL_PATTERNS = 64


def _rules_by_connection(rules: CatalogFilter) -> DataFrame:
    """The given rules, one row a connection. A second one would double the source's rows, so it fails the run instead."""
    repeated = F.raise_error(F.concat(F.lit("several rules for connection "), F.col("connection_qn")))
    given = rules.per_connection.groupBy("connection_qn").agg(
        F.count("*").alias("n"), *[F.max(F.nullif(F.col(c), F.lit(""))).alias(c) for c in RULE_COLUMNS[1:]]
    )
    return given.withColumn("include_re", F.when(F.col("n") > 1, repeated).otherwise(F.col("include_re"))).drop("n")


def _admitted_schemas(df: DataFrame, schema: str, key: Column, rules: CatalogFilter) -> DataFrame:
    """(connection_qn, `schema`, exclude_table_re): the admitted schemas of `df`. Patterns are tried once for each connection and
    schema; these are made distinct before anything is moved, which leaves few rows of any number."""
    places = df.select("connection_qn", F.col(schema), key.alias("schema_key")).distinct()
    include = F.coalesce("include_re", F.lit(rules.include or INCLUDE_ALL))
    exclude = F.coalesce("exclude_re", F.lit(rules.exclude or EXCLUDE_NONE))
    key = F.col("schema_key")
    admitted = F.rlike(key, rules._cased_column(include)) & ~F.rlike(key, rules._cased_column(exclude))
    table_re = F.coalesce("exclude_table_re", F.lit(rules.exclude_table or None).cast("string"))
    decided = places.join(_rules_by_connection(rules), "connection_qn", "left").where(admitted)
    return decided.select("connection_qn", schema, table_re.alias("exclude_table_re"))


def _keep_per_connection(df: DataFrame, schema: str, key: Column, rules: CatalogFilter, table: str | None) -> DataFrame:
    """Source rows meet their schema's decision in one join, of which the small side prunes the large one's scan at run time.
    Table patterns are literals of the plan, told apart by a comparison, so no row compiles one."""
    decided = _admitted_schemas(df, schema, key, rules)
    if not table:
        return df.join(decided.drop("exclude_table_re"), ["connection_qn", schema], "left_semi")
    kept = df.join(decided, ["connection_qn", schema])
    pattern, name = F.col("exclude_table_re"), F.col(table)
    given = rules.per_connection.select(F.nullif("exclude_table_re", F.lit("")).alias("re")).where("re is not null").distinct()
    patterns = [row["re"] for row in given.limit(LITERAL_PATTERNS + 1).collect()]
    if rules.exclude_table and rules.exclude_table not in patterns:
        patterns.append(rules.exclude_table)
    if len(patterns) <= LITERAL_PATTERNS:
        for literal in sorted(patterns):
            kept = kept.where(~((pattern == literal) & rules.matches(name, literal)) | pattern.isNull() | name.isNull())
    else:
        names = kept.select(pattern, name).distinct().where(F.rlike(name, rules._cased_column(pattern)))
        kept = kept.join(names, ["exclude_table_re", table], "left_anti")
    return kept.select(*df.columns)


def hidden_in_picker(
    schema: Column, patterns: Iterable[str] = PICKER_HIDDEN_SCHEMAS, case_sensitive: bool = False
) -> Column:
    """True when the schema matches any of the patterns."""
    rules = CatalogFilter(case_sensitive=case_sensitive)
    hidden = F.lit(False)
    for pattern in patterns:
        hidden = hidden | rules.matches(schema, pattern)
    return hidden


def filter_map_pattern(selection: dict[str, list[str]], nothing: str) -> str:
    """Turn `{"^db$": ["^schema$", ...]}` into one pattern on `<catalog>.<schema>`.

    An empty schema list selects the whole catalog; an empty map gives `nothing` (the pattern for "no selection").
    """
    parts = []
    for catalog, schemas in selection.items():
        catalog_re = _unanchored(catalog)
        if not schemas:
            parts.append(rf"^{catalog_re}\.")
        parts.extend(rf"^{catalog_re}\.{_unanchored(schema)}$" for schema in schemas)
    return "|".join(parts) or nothing


def _unanchored(pattern: str) -> str:
    """Drop the outer anchors and group what is left, so that it can be one half of the key."""
    inner = pattern.removeprefix("^").removesuffix("$")
    return inner if re.fullmatch(r"[\w-]*", inner) else f"(?:{inner})"

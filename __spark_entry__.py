
from __future__ import annotations

import sys
from collections.abc import Callable, Mapping
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lodestone.dialect import SYSTEM_SCHEMAS, Dialect  # noqa: E402
from lodestone.functions.source import error_class, region_from_host  # noqa: E402
from lodestone.functions.values import coerce_numeric, epoch_ms, finite_or_null, safe_str, when_set  # noqa: E402
from lodestone.operators import diff as D  # noqa: E402
from lodestone.operators import entities as E  # noqa: E402
from lodestone.operators import inventory as I  # noqa: E402
from lodestone.operators import quality as Q  # noqa: E402
from lodestone.operators.constraints import constraint_roles  # noqa: E402
from lodestone.operators.failures import classified  # noqa: E402
from lodestone.operators.feed import lineage_parse_feed, lineage_parse_feed_from_json  # noqa: E402
from lodestone.operators.filters import INCLUDE_ALL, CatalogFilter, connection_rules, filter_map_pattern  # noqa: E402
from lodestone.operators.settings import latest_settings, settings_map  # noqa: E402
from lodestone.plans.extraction import EntityStreams, extract  # noqa: E402
from lodestone.plans.families import Family, FamilyStreams  # noqa: E402
from lodestone.plans.seed_views import SEED_VIEWS  # noqa: E402
from lodestone.plans.sql_text import text_extract  # noqa: E402
from lodestone.session import shared_folder, tune  # noqa: E402
from lodestone.sinks.jsonl import current_delivery, delivered_files, read_stream  # noqa: E402
from lodestone.sinks.ordered import read_ordered, write_ordered  # noqa: E402
from lodestone.sinks.snapshots import SnapshotStore, changed_only, stored_extract  # noqa: E402
from lodestone.sources.bucketed import write_bucketed_catalog  # noqa: E402
from lodestone.sources.catalog import RELATION_SCHEMAS, Catalog, catalog_from, read_parquet_catalog  # noqa: E402
from lodestone.sources.derived import DerivedCatalog, table  # noqa: E402
from oracle import catalog as catalog_oracle  # noqa: E402
from oracle import seed_views as seed_view_oracle  # noqa: E402

try:
    import corpus_pipeline
    from lodestone.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "lodestone.llm"):
        raise
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
CONNECTIONS = catalog_oracle.CONNECTIONS
TEMP_TABLES = CatalogFilter(exclude_table="_TMP$")
TEXT_RULES = CatalogFilter(include=r"^def\.nation_1", exclude=r"^def\.NATION_12$", exclude_table="_TMP$")
TABLE_NAMES = ("connection_qn", "table_schema", "table_name", "table_type")

Query = Callable[[SparkSession, str], DataFrame]


def _catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    return DerivedCatalog(spark, sf_dir, CONNECTIONS)


def _on_catalog(build: Callable[[Catalog], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_catalog(tune(spark), sf_dir))


@lru_cache
def _stored_root(application: str, sf_dir: str) -> str:
    """The derived catalog, stored by table once an application."""
    spark = SparkSession.active()
    root = shared_folder(spark, "catalog")
    write_bucketed_catalog(spark, _catalog(spark, sf_dir), root)
    return root


def _on_stored(build: Callable[[Catalog], DataFrame]) -> Query:
    """A query over the catalog as a user has it: written by an earlier run, read back from its files."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return build(read_parquet_catalog(spark, _stored_root(spark.sparkContext.applicationId, sf_dir)))

    return query


def _from_text(name: str, rules: CatalogFilter = CatalogFilter()) -> Query:
    return lambda spark, sf_dir: text_extract(spark, _catalog(tune(spark), sf_dir), name, rules)


def _on_streams(build: Callable[[EntityStreams], DataFrame]) -> Query:
    return _on_catalog(lambda catalog: build(EntityStreams(catalog)))


def flatten(df: DataFrame) -> DataFrame:
    """Entities as flat rows: references as type and qualified name, custom attributes with a prefix."""
    columns: list[Column] = [F.col(c) for c in df.columns if c not in ("attributes", "customAttributes")]
    attributes = df.schema["attributes"].dataType
    taken = set(attributes.fieldNames())
    for field in attributes.fields:
        value = F.col(f"attributes.{field.name}")
        if isinstance(field.dataType, T.StructType):
            qn = f"{field.name}QualifiedName"
            columns.append(value["typeName"].alias(f"{field.name}TypeName"))
            columns.append(
                value["uniqueAttributes"]["qualifiedName"].alias(
                    f"{field.name}RefQualifiedName" if qn in taken else qn
                )
            )
        else:
            columns.append(value.alias(field.name))
    if "customAttributes" in df.columns:
        names = df.schema["customAttributes"].dataType.fieldNames()
        columns += [F.col(f"customAttributes.{n}").alias(f"custom_{n}") for n in names]
    return df.select(*columns)


# Columns of the shared table stream that one of its two types never has.
NOT_IN_TABLE = ("definition", "defaultCatalogName", "defaultSchemaName")
NOT_IN_VIEW = ("rowCount", "subType", "isPartitioned", "partitionCount")


def _of_type(df: DataFrame, type_name: str, absent: tuple[str, ...]) -> DataFrame:
    return flatten(df.where(F.col("typeName") == type_name)).drop(*absent)


def _with_attribute(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.withColumn("attributes", F.col("attributes").withField(name, value))


# ---- filters ------------------------------------------------------------------------------------------------


def _kept_names(rules: CatalogFilter) -> Query:
    return _on_catalog(lambda c: I.accessible_tables(c, rules).select(*TABLE_NAMES))


def _filter_per_connection(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    config = connection_rules(
        spark,
        {"default/mysql/1": (r"^def\.NATION_1", None, None), "default/mysql/2": (None, "nation_2", "_tmp$")},
    )
    rules = CatalogFilter(per_connection=config)
    return I.accessible_tables(_catalog(spark, sf_dir), rules).select(*TABLE_NAMES)


def _hidden_schemas(catalog: Catalog) -> DataFrame:
    """The picker over schemas of which some match a hidden pattern without being the server's own."""
    name = F.col("schema_name")
    renamed = F.when(name == "NATION_3", "information_schema_old").when(name == "NATION_4", "Metrics_Schema_2").otherwise(name)
    relations = {relation: getattr(catalog, relation) for relation in RELATION_SCHEMAS}
    return I.schema_picker(catalog_from({**relations, "schemata": catalog.schemata.withColumn("schema_name", renamed)}))


def _two_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of two connections of one server family and one of another, which has other system schemas, another catalog name and
    attributes of its own."""
    catalog = _catalog(tune(spark), sf_dir)
    other = Family(Dialect(system_schemas=(*SYSTEM_SCHEMAS, "NATION_5"), default_catalog="main"))
    # This family's catalog name is the server's, not the one in its rows.
    other = other.with_attribute(spark, "table", "databaseName", lambda rows, stamp: F.lit(stamp.dialect.default_catalog))
    other = other.with_attribute(spark, "table", "description", lambda rows, stamp: F.upper(F.coalesce("remarks", F.lit("none"))))
    other = other.with_attribute(spark, "table", "comparison", lambda rows, stamp: F.col("table_collation"))
    other = other.with_attribute(spark, "table", "engine", lambda rows, stamp: F.lower(F.coalesce("engine", F.lit("-"))), custom=True)
    family = F.when(F.col("connection_qn") == "default/mysql/3", "other").otherwise("common")
    streams = FamilyStreams(catalog, {"common": Family(), "other": other}, catalog.connections.select("connection_qn", family.alias("family")))
    a = "attributes."
    return streams["table"].select(
        "connection_qn", "typeName", a + "qualifiedName", a + "databaseName", a + "schemaName", a + "description", a + "comparison", "customAttributes.engine"
    )


def _other_names(catalog: Catalog) -> DataFrame:
    """Columns mapped from an extract with the other names that mappers look for, some of them beside the first ones."""
    rows = I.column_inventory(catalog).withColumnsRenamed(
        {"table_catalog": "datname", "table_schema": "schema_name", "max_length": "character_maximum_length"}
    )
    return flatten(E.column_entities(rows.drop("numeric_scale").withColumn("database_name", F.col("datname"))))


# ---- JSON ---------------------------------------------------------------------------------------------------


def _lines(df: DataFrame) -> DataFrame:
    return df.select(E.entity_json(df).alias("value"))


def _entity_json(streams: EntityStreams) -> DataFrame:
    return Q.union_all([_lines(df).select(F.lit(name).alias("stream"), "value") for name, df in streams.items()])


def _entity_json_fields(streams: EntityStreams) -> DataFrame:
    """Every line parsed back, with one field per stream that shows the text form is right."""
    detail = {
        "database": "$.attributes.description",
        "schema": "$.attributes.tableCount",
        "table": "$.customAttributes.data_length",
        "column": "$.customAttributes.buffer_length",
        "procedure": "$.attributes.definition",
    }
    line = F.col("value")
    return Q.union_all(
        [
            _lines(df).select(
                F.lit(name).alias("stream"),
                F.get_json_object(line, "$.typeName").alias("type_name"),
                F.get_json_object(line, "$.attributes.qualifiedName").alias("qualified_name"),
                F.get_json_object(line, detail[name]).alias("detail"),
            )
            for name, df in streams.items()
        ]
    )


def _delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All streams written as JSON lines and verified, then counted from what was delivered."""
    catalog = _catalog(tune(spark), sf_dir)
    delivery = extract(spark, catalog, shared_folder(spark, "delivery"))
    return Q.union_all(
        [
            read_stream(spark, f"{delivery.prefix}/{name}").select(F.lit(name).alias("stream"), "connection_id")
            for name in delivery.lines
        ]
    ).groupBy("stream", "connection_id").agg(F.count("*").alias("lines"))


def _delivery_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and bytes of each stream, from the list of files that the last delivery published."""
    prefix = shared_folder(spark, "delivery")
    extract(spark, _catalog(tune(spark), sf_dir), prefix)
    files = delivered_files(spark, current_delivery(spark, prefix))
    return files.groupBy("stream").agg(F.sum("lines").alias("lines"), F.sum("bytes").alias("bytes"))


def _in_order(build: Callable[[Catalog], DataFrame], order: tuple[str, ...]) -> Query:
    """Rows of an extract written in one order over all files, with the position each has there."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = shared_folder(spark, "ordered")
        write_ordered(build(_catalog(tune(spark), sf_dir)).select(*order), path, order)
        return read_ordered(spark, path)

    return query


def _feed_from_json(streams: EntityStreams) -> DataFrame:
    return lineage_parse_feed_from_json(_lines(streams["table"]).unionByName(_lines(streams["procedure"])))


def _orphans(catalog: Catalog) -> DataFrame:
    """Columns of a catalog that lost one schema's tables and has another's base tables as sequences."""
    relations = {name: getattr(catalog, name) for name in RELATION_SCHEMAS}
    schema, kind = F.col("table_schema"), F.col("table_type")
    sequence = F.when((schema == "NATION_8") & (kind == "BASE TABLE"), "SEQUENCE").otherwise(kind)
    tables = catalog.tables.where(schema != "NATION_7").withColumn("table_type", sequence)
    return Q.orphan_columns(catalog_from({**relations, "tables": tables}), TEMP_TABLES)


# ---- checks, over entities with defects put in --------------------------------------------------------------


def _hierarchy(catalog: Catalog) -> DataFrame:
    """Columns of all tables against tables without the temporary ones; one schema's tables name a wrong parent."""
    streams = EntityStreams(catalog)
    kept = EntityStreams(catalog, TEMP_TABLES)
    wrong = F.when(F.col("attributes.schemaName") == "NATION_7", F.lit("default/mysql/x/def/NATION_7")).otherwise(
        F.col("attributes.schemaQualifiedName")
    )
    tables = _with_attribute(kept["table"], "schemaQualifiedName", wrong)
    connections = catalog.connections.select(
        F.lit("Connection").alias("typeName"), F.struct(F.col("connection_qn").alias("qualifiedName")).alias("attributes")
    )
    children = [streams["column"], tables, streams["schema"], streams["database"], streams["procedure"]]
    return Q.hierarchy_violations(children, [connections, streams["database"], streams["schema"], tables])


def _required_attributes(streams: EntityStreams) -> DataFrame:
    tables = _with_attribute(
        streams["table"],
        "description",
        F.when(F.col("customAttributes.engine") != "", F.col("attributes.description")),
    )
    columns = _with_attribute(
        streams["column"], "dataType", F.when(F.col("attributes.dataType") != "JSON", F.col("attributes.dataType"))
    )
    checked = (streams["database"], streams["schema"], tables, columns)
    return Q.union_all([Q.missing_attributes(df, _required_of(df)) for df in checked])


def _required_of(df: DataFrame) -> dict[str, tuple[str, ...]]:
    present = set(df.schema["attributes"].dataType.fieldNames())
    return {t: names for t, names in Q.REQUIRED_ATTRIBUTES.items() if set(names) <= present}


def _all_findings(streams: EntityStreams) -> DataFrame:
    """Everything wrong with faulty streams, counted: schemas delivered as databases; tables without description, with wrong
    references and tenants; columns without type."""
    tables = _with_attribute(streams["table"], "description", F.when(F.col("customAttributes.engine") != "", F.col("attributes.description")))
    ref, schema = F.col(f"attributes.{E.SCHEMA_REF}"), F.col("attributes.schemaName")
    tables = _with_attribute(tables, E.SCHEMA_REF, F.when(schema == "NATION_5", ref.withField("typeName", F.lit("Database"))).when(schema != "NATION_7", ref))
    tenant = F.when(F.col("connection_qn") == "default/mysql/2", F.lit("other")).otherwise(F.col("attributes.tenantId"))
    tables = _with_attribute(tables, "tenantId", tenant)
    columns = _with_attribute(streams["column"], "dataType", F.when(F.col("attributes.dataType") != "JSON", F.col("attributes.dataType")))
    faulty = {"database": streams["schema"], "schema": streams["schema"], "table": tables, "column": columns, "procedure": streams["procedure"]}
    return Q.findings(faulty, "mysql", E.DEFAULT_TENANT).groupBy("stream", "check", "typeName", "detail").agg(F.count("*").alias("n"))


def _parent_conflicts(streams: EntityStreams) -> DataFrame:
    """Fifth columns lose their table, sixth columns get a view besides their table."""
    order, a = F.col("attributes.order"), "attributes."
    df = _with_attribute(streams["column"], "tableName", F.when(order != 5, F.col(a + "tableName")))
    df = _with_attribute(df, "viewName", F.coalesce(F.col(a + "viewName"), F.when(order == 6, F.col(a + "name"))))
    df = _with_attribute(
        df,
        "viewQualifiedName",
        F.coalesce(F.col(a + "viewQualifiedName"), F.when(order == 6, F.col(a + "qualifiedName"))),
    )
    return Q.parent_conflicts(df)


def _bad_references(streams: EntityStreams) -> DataFrame:
    """Three schemas' tables and procedures point to a wrong type, to an empty name, and to nothing; so do their columns'
    parents."""
    ref = F.col(f"attributes.{E.SCHEMA_REF}")
    schema = F.col("attributes.schemaName")
    wrong = (
        F.when(schema == "NATION_5", ref.withField("typeName", F.lit("Database")))
        .when(schema == "NATION_6", ref.withField("uniqueAttributes.qualifiedName", F.lit("")))
        .when(schema != "NATION_7", ref)
    )
    tables, procedures = (_with_attribute(streams[name], E.SCHEMA_REF, wrong) for name in ("table", "procedure"))
    parent = F.col(f"attributes.{E.TABLE_REF}")
    column = F.col("attributes.schemaName")
    wrong_parent = (
        F.when(column == "NATION_5", parent.withField("typeName", F.lit("View")))
        .when(column == "NATION_6", parent.withField("uniqueAttributes.qualifiedName", F.lit("")))
        .when(column != "NATION_7", parent)
    )
    columns = _with_attribute(streams["column"], E.TABLE_REF, wrong_parent)
    checked = (tables, procedures, columns, streams["schema"], streams["database"])
    return Q.union_all([Q.bad_references(df) for df in checked])


def _wrong_constants(streams: EntityStreams) -> DataFrame:
    other = F.when(F.col("connection_qn") == "default/mysql/2", F.lit("other")).otherwise(F.col("attributes.tenantId"))
    wrong = {name: _with_attribute(streams[name], "tenantId", other) for name in ("table", "procedure")}
    return Q.union_all([Q.wrong_constants(wrong.get(name, df), "mysql", E.DEFAULT_TENANT) for name, df in streams.items()])


def _invalid_json(streams: EntityStreams) -> DataFrame:
    """Lines of all streams. Schemas with more tables than views get NaN, which JSON does not know."""
    lines = []
    for name, df in streams.items():
        line = E.entity_json(df)
        if name == "schema":
            broken = F.regexp_replace(line, '"viewsCount":[0-9]+', '"viewsCount":NaN')
            line = F.when(F.col("attributes.tableCount") > F.col("attributes.viewsCount"), broken).otherwise(line)
        lines.append(df.select(F.col("attributes.qualifiedName").alias("qualified_name"), line.alias("value")))
    return Q.invalid_json(Q.union_all(lines)).select("qualified_name")


def _stream_types(streams: EntityStreams) -> DataFrame:
    """Tables delivered as columns and procedures delivered among the tables."""
    mixed = streams["table"].select("typeName").unionByName(streams["procedure"].select("typeName"))
    sound = {name: streams[name] for name in ("database", "schema", "procedure")}
    return Q.unexpected_stream_types({"column": streams["table"], "table": mixed, **sound})


def _count_floors(spark: SparkSession, sf_dir: str) -> DataFrame:
    streams = EntityStreams(_catalog(tune(spark), sf_dir))
    floors = {"Database": 3, "Schema": 25, "Table": 40, "View": 7, "Column": 500, "Procedure": 1_000_000_000, "Index": 1}
    return Q.count_floors(spark, list(streams.values()), floors)


CHANGED = ("connection_qn", "typeName", "attributes.qualifiedName", "attributes.rowCount", "attributes.description")

# ---- snapshots ----------------------------------------------------------------------------------------------


def _table_snapshots(streams: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Old: tables made before 1998. New: without urgent ones and without one connection; high ones have grown."""
    tables = streams["table"]
    description, rows = F.col("attributes.description"), F.col("attributes.rowCount")
    old = tables.where(F.col("attributes.sourceCreatedAt") < 883_612_800_000)  # 1998-01-01 UTC
    new = tables.where((description != "1-URGENT") & (F.col("connection_qn") != "default/mysql/3"))
    return old, _with_attribute(new, "rowCount", F.when(description == "2-HIGH", rows + 1).otherwise(rows))


def _procedure_snapshots(streams: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Some names are shared by a procedure and a function; the new side lost the French functions."""
    old = streams["procedure"]
    gone = (F.col("attributes.subType") == "FUNCTION") & (F.col("attributes.description") == "fr")
    return old, old.where(~gone)


def _two_runs(spark: SparkSession, sf_dir: str) -> tuple[SnapshotStore, DataFrame]:
    """A store after a run over the old tables and procedures and one over the new, with the new tables."""
    streams = EntityStreams(_catalog(tune(spark), sf_dir))
    # Both runs' tables, and those to be published, come from one extract, which is made once.
    extracted = {**streams, "table": stored_extract(spark, streams["table"])}
    (old_tables, new_tables), (old_procedures, new_procedures) = _table_snapshots(extracted), _procedure_snapshots(extracted)
    store = SnapshotStore(spark, shared_folder(spark, "snapshots"))
    store.publish([old_tables, old_procedures])
    store.publish([new_tables, new_procedures])
    return store, new_tables


def _incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = _two_runs(spark, sf_dir)
    return store.changes(store.current())


def _incremental_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second run has to publish of its tables, from what it stored."""
    store, tables = _two_runs(spark, sf_dir)
    return changed_only(tables, store.changes(store.current())).select(*CHANGED)


# ---- scalar rules -------------------------------------------------------------------------------------------


def _epoch_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(tune(spark), sf_dir, "orders")
    readable = F.col("o_orderpriority") != "5-LOW"
    forms = ["yyyy-MM-dd HH:mm:ss", "yyyyMMdd", "d MMM yyyy", "MM/dd/yyyy", "MMMM d, yyyy HH:mm", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd"]
    form = [F.when(F.col("o_orderkey") % len(forms) == i, F.date_format("o_orderdate", f)) for i, f in enumerate(forms)]
    rows = orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        F.when(readable, F.coalesce(*form)).otherwise("not-a-date").alias("text"),
        F.when(readable, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("zoned"),
        F.when(F.col("o_orderstatus") == "P", float("nan")).otherwise(F.col("o_totalprice")).alias("price"),
    )
    return rows.select(
        "o_orderkey",
        epoch_ms(rows, "o_orderdate").alias("from_time"),
        epoch_ms(rows, "text").alias("from_text"),
        epoch_ms(rows, "zoned").alias("from_zoned_text"),
        epoch_ms(rows, "o_custkey").alias("from_number"),
        epoch_ms(rows, "price").alias("from_double"),
        when_set(epoch_ms(rows, "o_custkey")).alias("set_only"),
    )


def _weak_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with prices that are partly NULL, NaN or infinite."""
    line = F.col("l_linenumber")
    weak = (
        F.when(line == 7, float("nan")).when(line == 6, float("inf")).when(line != 5, F.col("l_extendedprice"))
    )
    lines = table(tune(spark), sf_dir, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag", weak.alias("weak"),
        F.when(line != 5, line).alias("whole"),
    )


def _safe_str(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _weak_numbers(spark, sf_dir)
    names = {"whole": "l_quantity", "fraction": "l_tax", "weak": "weak", "number": "l_linenumber", "text": "l_returnflag"}
    return rows.select("l_orderkey", *(safe_str(rows, source).alias(name) for name, source in names.items()))


def _coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _weak_numbers(spark, sf_dir)
    return rows.select(
        "l_orderkey",
        coerce_numeric(rows, "weak").alias("coerced"),
        finite_or_null(rows, "weak").alias("finite"),
        coerce_numeric(rows, "whole").alias("whole"),
    )


def _region(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("s_nationkey") % 4
    managed = F.format_string("db%d.abc123.zone-%d-a.rds.amazonaws.com", "s_suppkey", "s_nationkey")
    host = F.when(kind == 1, "localhost").when(kind == 2, "").when(kind == 3, managed)
    return table(tune(spark), sf_dir, "supplier").select("s_suppkey", region_from_host(host).alias("region"))


def _error_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    errno = (
        F.when(F.col("event_type") == "view", 1040)
        .when(F.col("event_type") == "signup", 1226)
        .when(F.col("event_type") == "error", 2006)
        .when(F.col("event_type") == "click", 1045)
    )
    return table(tune(spark), sf_dir, "events").select("event_id", error_class(errno).alias("error_class"))


def _error_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of which each wraps the one before it, in chains of up to about a hundred; some run in circles."""
    event, kind = F.col("event_id"), F.col("event_type")
    number = (
        F.when((kind == "error") & (event % 5 == 0), 2006)
        .when((kind == "view") & (event % 40 == 0), 1040)
        .when((kind == "click") & (event % 45 == 0), 1045)
    )
    cause = F.when(event % 97 != 0, event - 1).when(event % 970 == 0, event + 9)
    errors = table(tune(spark), sf_dir, "events").select(
        event.alias("error_id"),
        F.when(event % 11 == 0, event - 2).alias("orig_id"),
        cause.alias("cause_id"),
        number.cast("long").alias("number"),
        (event % 61 == 0).alias("is_timeout"),
    )
    return classified(errors).select("error_id", "errno", "error_class", "retryable")


def _setting_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = F.when(F.col("value") >= 20, "extra.").otherwise("")
    return table(tune(spark), sf_dir, "events").select(
        "user_id", F.concat(prefix, "event_type").alias("key"), F.col("props").alias("value"), "event_id"
    )


def _latest_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_settings(_setting_rows(spark, sf_dir), "user_id", "event_id")


def _settings_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maps as text, a line per key."""
    maps = settings_map(_setting_rows(spark, sf_dir), "user_id", "event_id")

    def text(c: str) -> Column:
        entries = F.array_sort(F.map_entries(c))
        return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), "\n")

    return maps.select("user_id", text("settings").alias("settings"), text("extra").alias("extra"))


# ---- registry -----------------------------------------------------------------------------------------------

_MAP = filter_map_pattern({"^def$": ["^NATION_4$", "^NATION_11$", "^NATION_2[0-9]$"]}, INCLUDE_ALL)


def catalog_queries() -> dict[str, Query]:
    """The queries over catalogs and example tables; each takes (spark, sf_dir)."""
    return {
        "database_inventory": _on_catalog(I.database_inventory),
        "schema_inventory": _on_catalog(I.schema_inventory),
        "schema_picker": _on_catalog(I.schema_picker),
        "schema_picker_hidden": _on_catalog(_hidden_schemas),
        "accessible_table_count": _on_catalog(lambda c: I.accessible_table_count(c, TEMP_TABLES)),
        "tables_per_schema": _on_catalog(I.tables_per_schema),
        "table_inventory": _on_catalog(I.table_inventory),
        "partition_summary": _on_catalog(I.partition_summary),
        "constraint_roles": _on_catalog(constraint_roles),
        "column_inventory": _on_catalog(I.column_inventory),
        "column_inventory_without_temp": _on_catalog(
            lambda c: I.column_inventory(c, TEMP_TABLES).select(
                "connection_qn", "table_schema", "table_name", "column_name", "table_type", "constraint_type"
            )
        ),
        "schema_order": _in_order(I.schema_inventory, ("connection_qn", "schema_name")),
        "column_order": _in_order(I.column_inventory, ("connection_qn", "table_schema", "table_name", "ordinal_position")),
        "routine_inventory": _on_catalog(I.routine_inventory),
        "filter_include_exclude": _kept_names(CatalogFilter(include=r"^def\.nation_1", exclude=r"^def\.NATION_12$")),
        "filter_temp_tables": _kept_names(CatalogFilter(exclude_table="_(tmp|scratch)$")),
        "filter_per_connection": _filter_per_connection,
        "filter_current_database": _kept_names(CatalogFilter(include=r"^shop\.nation_1", exclude=r"^def\.", current_database="shop")),
        "filter_map": _kept_names(CatalogFilter(include=_MAP)),
        "entity_database": _on_streams(lambda s: flatten(s["database"])),
        "entity_schema": _on_streams(lambda s: flatten(s["schema"])),
        "entity_table": _on_streams(lambda s: _of_type(s["table"], E.TABLE, NOT_IN_TABLE)),
        "entity_view": _on_streams(lambda s: _of_type(s["table"], E.VIEW, NOT_IN_VIEW)),
        "entity_column": _on_streams(lambda s: flatten(s["column"])),
        "entity_procedure": _on_streams(lambda s: flatten(s["procedure"])),
        "entity_two_families": _two_families,
        "entity_other_names": _on_catalog(_other_names),
        "entity_json": _on_streams(_entity_json),
        "jsonl_delivery": _delivery,
        "delivery_manifest": _delivery_manifest,
        "entity_json_fields": _on_streams(_entity_json_fields),
        "lineage_parse_feed": _on_streams(lambda s: lineage_parse_feed(s["table"], s["procedure"])),
        "lineage_parse_feed_json": _on_streams(_feed_from_json),
        "orphan_columns": _on_catalog(_orphans),
        "qn_hierarchy_violations": _on_catalog(_hierarchy),
        "duplicate_qn": _on_streams(lambda s: Q.duplicate_qualified_names(s["procedure"])),
        "required_attributes": _on_streams(_required_attributes),
        "all_findings": _on_streams(_all_findings),
        "parent_conflicts": _on_streams(_parent_conflicts),
        "bad_references": _on_streams(_bad_references),
        "wrong_constants": _on_streams(_wrong_constants),
        "invalid_json": _on_streams(_invalid_json),
        "stream_type_check": _on_streams(_stream_types),
        "entity_count_floors": _count_floors,
        "snapshot_diff": _on_streams(lambda s: D.snapshot_diff(*_table_snapshots(s))),
        "snapshot_diff_shared_names": _on_streams(lambda s: D.snapshot_diff(*_procedure_snapshots(s))),
        "undelivered_connections": _on_streams(lambda s: D.undelivered_connections(*_table_snapshots(s))),
        "incremental_changes": _on_streams(lambda s: D.incremental_changes(*_table_snapshots(s))),
        "changed_entities": _on_streams(
            lambda s: D.changed_entities(*_table_snapshots(s)).select(*CHANGED)
        ),
        "incremental_run": _incremental_run,
        "incremental_entities": _incremental_entities,
        "stored_schema_inventory": _on_stored(I.schema_inventory),
        "stored_table_inventory": _on_stored(I.table_inventory),
        "stored_partition_summary": _on_stored(I.partition_summary),
        "stored_constraint_roles": _on_stored(constraint_roles),
        "stored_column_inventory": _on_stored(I.column_inventory),
        "stored_routine_inventory": _on_stored(I.routine_inventory),
        "stored_entity_column": _on_stored(lambda c: flatten(EntityStreams(c)["column"])),
        "text_database": _from_text("database"),
        "text_schema": _from_text("schema"),
        "text_table": _from_text("table"),
        "text_column": _from_text("column"),
        "text_procedure": _from_text("procedure"),
        "text_with_rules": lambda spark, sf_dir: _from_text("table", TEXT_RULES)(spark, sf_dir).select(*TABLE_NAMES),
        "scalar_epoch_ms": _epoch_ms,
        "scalar_safe_str": _safe_str,
        "scalar_coerce_numeric": _coerce_numeric,
        "region_from_host": _region,
        "error_class": _error_class,
        "error_causes": _error_causes,
        "latest_settings": _latest_settings,
        "settings_map": _settings_map,
        **{name: (lambda spark, sf_dir, view=view: view(tune(spark), sf_dir)) for name, view in SEED_VIEWS.items()},
    }


def catalog_sql() -> dict[str, str]:
    return {**catalog_oracle.SQL, **seed_view_oracle.SQL}


def queries() -> dict[str, Query]:
    """One entry per implemented query or operator, with those on training data where they are installed."""
    return {**catalog_queries(), **(llm.QUERIES | {"pipeline": corpus_pipeline.run} if llm else {})}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query over the same Parquet tables."""
    return {**catalog_sql(), **(llm.ORACLE_SQL if llm else {})}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: table and view entities of all connections, as flat rows."""
    return flatten(EntityStreams(_catalog(tune(spark), SMOKE_DIR))["table"])

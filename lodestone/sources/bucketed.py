"""A stored catalog laid out by table, so that the extracts join and reduce it without moving its rows."""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession

from lodestone.sinks.commits import CommitLog
from lodestone.sources.catalog import RELATION_SCHEMAS, Catalog, catalog_from

_TABLE = ("connection_qn", "table_schema", "table_name")

# The key by which each relation is dealt and sorted. A table has at most a few thousand columns (the server's limit), so buckets by
# table are even also where one connection or schema holds most tables.
BUCKET_KEYS: dict[str, tuple[str, ...]] = {
    "connections": ("connection_qn",),
    "schemata": ("connection_qn", "schema_name"),
    "tables": _TABLE,
    "columns": _TABLE,
    "partitions": _TABLE,
    "views": _TABLE,
    "key_column_usage": _TABLE,
    "table_constraints": _TABLE,
    "routines": ("connection_qn", "routine_schema", "routine_name"),
}


# Rows of the columns relation in a bucket, about: some hundred MB of memory to sort.
BUCKET_ROWS = 250_000


def _name(root: str, relation: str) -> str:
    return f"lodestone_{sha256(root.encode()).hexdigest()[:16]}_{relation}"


def _layout(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, f"{root}/_layout")


def is_bucketed(spark: SparkSession, root: str) -> bool:
    """Whether a whole bucketed catalog lies there; its layout is written last."""
    return _layout(spark, root).latest() is not None


def write_bucketed_catalog(spark: SparkSession, catalog: Catalog, root: str, buckets: int | None = None) -> None:
    """Store every relation below `root`, a new folder, as one sorted file a bucket.

    By default there are as many buckets as shuffle partitions, or as keep about BUCKET_ROWS columns in each, so that a task sorts its
    bucket in memory whatever the catalog's size. Sorted by connection first, files let a filter on connections skip most of their
    rows. A catalog that makes rows from shorter ones can have those moved (`dealt`), and make relations from what is stored already
    (`stored`).
    """
    if buckets is None:
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-catalog.columns.count() // BUCKET_ROWS))
    for relation, key in BUCKET_KEYS.items():
        # The table only carries the layout to the writer; without it the files stay.
        name = f"{_name(root, relation)}_w"

        def deal(rows: DataFrame) -> DataFrame:
            return rows.repartition(buckets, *key)

        rows = catalog.dealt(relation, deal) if hasattr(catalog, "dealt") else deal(getattr(catalog, relation))
        writer = rows.write.format("parquet").bucketBy(buckets, *key).sortBy(*key).option("path", f"{root}/{relation}")
        writer.saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")
        if hasattr(catalog, "stored"):
            catalog.stored(relation, spark.read.schema(RELATION_SCHEMAS[relation]).parquet(f"{root}/{relation}"))
    _layout(spark, root).commit(1, {"buckets": buckets})


def read_bucketed_catalog(spark: SparkSession, root: str) -> Catalog:
    """The catalog that `write_bucketed_catalog` stored. Its layout is known to Spark by external tables in the session's catalog,
    made anew on each call; dropping them leaves the files."""
    found = _layout(spark, root).latest()
    if found is None:
        raise ValueError(f"no whole catalog in {root}")
    frames = {}
    for relation, schema in RELATION_SCHEMAS.items():
        name, key = _name(root, relation), ", ".join(BUCKET_KEYS[relation])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        path = f"{root}/{relation}".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
            f"INTO {found[1]['buckets']} BUCKETS LOCATION '{path}'"
        )
        frames[relation] = spark.table(name)
    return catalog_from(frames)

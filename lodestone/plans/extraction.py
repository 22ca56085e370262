"""A whole extraction: source relations in, entity streams out, delivered as JSON lines."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators import entities as E
from lodestone.operators import inventory as I
from lodestone.operators.filters import KEEP_ALL, CatalogFilter
from lodestone.session import short_lived_shuffles
from lodestone.sinks.jsonl import Delivery, deliver
from lodestone.sources.catalog import Catalog, part_of


@dataclass(frozen=True)
class Stream:
    """How one output stream is made: the extract, the mapper, and the order of rows within a file."""

    rows: Callable[..., DataFrame]
    entities: Callable[[DataFrame, E.Stamp], DataFrame]
    order: tuple[str, ...] = ()
    filtered: bool = True

    def extract(self, catalog: Catalog, rules: CatalogFilter, stamp: E.Stamp) -> DataFrame:
        return self.rows(catalog, *((rules,) if self.filtered else ()), stamp.dialect)


# Views travel in the table stream. The include and exclude patterns do not apply to the database row.
STREAMS = {
    "database": Stream(I.database_inventory, E.database_entities, filtered=False),
    "schema": Stream(I.schema_inventory, E.schema_entities, ("schema_name",)),
    "table": Stream(I.table_inventory, E.table_entities),
    "column": Stream(I.column_inventory, E.column_entities, ("table_schema", "table_name", "ordinal_position")),
    "procedure": Stream(I.routine_inventory, E.procedure_entities),
}


def grouped_by_connection(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Rows grouped for writing one directory per connection, in order within a task.

    The extract rows are moved, not the much longer entity lines. Small connections share a task, and a connection
    larger than the advisory partition size is split over many.
    """
    grouped = rows.hint("rebalance", "connection_qn")
    return grouped.sortWithinPartitions("connection_qn", *order) if order else grouped


class EntityStreams(Mapping):
    """The five streams by name. A stream's plan is made when it is first asked for; nothing runs until it is used. `attributes` and
    `custom` hold builders that replace the mappers' (`families.Family`)."""

    def __init__(
        self,
        catalog: Catalog,
        rules: CatalogFilter = KEEP_ALL,
        stamp: E.Stamp = E.PLAIN,
        for_writing: bool = False,
        attributes: Mapping[str, Mapping[str, Callable[..., Column]]] | None = None,
        custom: Mapping[str, Mapping[str, Callable[..., Column]]] | None = None,
    ):
        self._source, self._stamp, self._for_writing = (catalog, rules, stamp), stamp, for_writing
        self._own = {E.OWN_ATTRIBUTES: attributes or {}, E.OWN_CUSTOM: custom or {}}
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            stream = STREAMS[name]
            rows = stream.extract(*self._source)
            if self._for_writing:
                rows = grouped_by_connection(rows, stream.order)
            for column, builders in self._own.items():
                if given := builders.get(name):
                    rows = rows.withColumn(column, F.struct(*(build(rows, self._stamp).alias(key) for key, build in given.items())))
            self._made[name] = stream.entities(rows, self._stamp)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(STREAMS)

    def __len__(self) -> int:
        return len(STREAMS)


# Streams whose rows are of one table each, and so can be made a part of the tables at a time.
BY_TABLE = ("table", "column")

# Source rows of columns in a part, about: moving them and what they are joined with makes some 2 GB of shuffle files.
PART_COLUMNS = 10_000_000


class PartedStreams(Mapping):
    """The streams by name for `deliver`: each as the DataFrames that give its rows one after the other, of those by table one a part."""

    def __init__(self, catalog: Catalog, parts: int, rules: CatalogFilter = KEEP_ALL, stamp: E.Stamp = E.PLAIN):
        self._catalog, self._parts, self._how = catalog, parts, (rules, stamp)

    def __getitem__(self, name: str) -> Iterator[DataFrame]:
        if name not in STREAMS:
            raise KeyError(name)
        parts = self._parts if name in BY_TABLE else 1
        catalogs = (part_of(self._catalog, part, parts) for part in range(parts))
        return (EntityStreams(catalog, *self._how, for_writing=True)[name] for catalog in catalogs)

    def __iter__(self) -> Iterator[str]:
        return iter(STREAMS)

    def __len__(self) -> int:
        return len(STREAMS)


# Lines name their place in every reference, so a whole catalog's take many times its own size as plain text.
COMPRESSION = "gzip"


def extract(
    spark: SparkSession,
    catalog: Catalog,
    prefix: str,
    rules: CatalogFilter = KEEP_ALL,
    stamp: E.Stamp = E.PLAIN,
) -> Delivery:
    """Run the extraction and deliver all streams below `prefix`, as compressed lines. A large catalog's tables are extracted in parts, one
    after the other, so that the disk holds the shuffle files of one part only."""
    with short_lived_shuffles(spark):
        parts = max(1, -(-catalog.columns.count() // PART_COLUMNS))
    return deliver(spark, PartedStreams(catalog, parts, rules, stamp), prefix, compression=COMPRESSION)

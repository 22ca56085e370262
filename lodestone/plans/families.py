"""Server families: names and kinds of a kind of server, and attributes its entities get in a way of their own."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.dialect import MYSQL, Dialect
from lodestone.operators import entities as E
from lodestone.operators.filters import KEEP_ALL, CatalogFilter
from lodestone.plans.extraction import STREAMS, EntityStreams
from lodestone.sources.catalog import RELATION_SCHEMAS, Catalog, catalog_from

# An attribute from the rows of the extract, whose columns it may use.
Builder = Callable[[DataFrame, E.Stamp], Column]
# What other streams and runs find entities by.
KEYS = ("qualifiedName", "connectionQualifiedName")


class MapperError(ValueError):
    """A builder does not fit the entities of its stream."""


def _no_rows(spark: SparkSession) -> Catalog:
    return catalog_from({name: spark.createDataFrame([], schema) for name, schema in RELATION_SCHEMAS.items()})


@dataclass(frozen=True)
class Family:
    """A server family. `attributes` and `custom` hold, by stream, builders in place of the common ones, or beside them."""

    dialect: Dialect = MYSQL
    attributes: Mapping[str, Mapping[str, Builder]] = field(default_factory=dict)
    custom: Mapping[str, Mapping[str, Builder]] = field(default_factory=dict)

    def with_attribute(self, spark: SparkSession, stream: str, name: str, builder: Builder, custom: bool = False) -> Family:
        """This family with one more builder, after trying it on an extract without rows: its columns must be there, and where
        the entities have the attribute already, it must be of the same type. Keys can't be given anew."""
        if stream not in STREAMS:
            raise MapperError(f"there is no stream {stream}; there are {', '.join(STREAMS)}")
        if name in KEYS and not custom:
            raise MapperError(f"{name} is a key")
        stamp = E.Stamp(dialect=self.dialect)
        rows = STREAMS[stream].extract(_no_rows(spark), KEEP_ALL, stamp)
        entities = STREAMS[stream].entities(rows, stamp)
        group = "customAttributes" if custom else "attributes"
        if group not in entities.columns:
            raise MapperError(f"entities of stream {stream} have no {group}")
        try:
            kind = rows.select(builder(rows, stamp).alias(name)).schema[name].dataType
        except Exception as error:
            raise MapperError(f"{stream}.{name}: {error}") from error
        known = {f.name: f.dataType for f in entities.schema[group].dataType.fields}
        if name in known and known[name] != kind:
            raise MapperError(f"{stream}.{name} is {known[name].simpleString()}, not {kind.simpleString()}")
        had = dict(self.custom if custom else self.attributes)
        had[stream] = {**had.get(stream, {}), name: builder}
        return replace(self, **{"custom" if custom else "attributes": had})


class FamilyStreams(Mapping):
    """The five streams of a catalog whose connections belong to several families.

    `families_of` (connection_qn, family) names each connection's; connections that are not in it are left out, and one that is in it
    twice fails the run. Each family's connections are extracted by its own dialect and mapped by its own builders, and a stream
    is the union; an attribute that only some families have is absent from the others' entities.
    """

    def __init__(self, catalog: Catalog, families: Mapping[str, Family], families_of: DataFrame, rules: CatalogFilter = KEEP_ALL, stamp: E.Stamp = E.PLAIN) -> None:
        twice = F.raise_error(F.concat(F.lit("several families for connection "), F.col("connection_qn")))
        one = families_of.groupBy("connection_qn").agg(F.count("*").alias("n"), F.max("family").alias("family"))
        one = one.select("connection_qn", F.when(F.col("n") > 1, twice).otherwise(F.col("family")).alias("family"))
        self._streams = []
        for name, family in families.items():
            mine = one.where(F.col("family") == name).select("connection_qn")
            relations = {r: getattr(catalog, r).join(mine, "connection_qn", "left_semi") for r in RELATION_SCHEMAS}
            own = replace(stamp, dialect=family.dialect)
            self._streams.append(EntityStreams(catalog_from(relations), rules, own, attributes=family.attributes, custom=family.custom))

    def __getitem__(self, name: str) -> DataFrame:
        whole = self._streams[0][name]
        for streams in self._streams[1:]:
            whole = whole.unionByName(streams[name], allowMissingColumns=True)
        return whole

    def __iter__(self) -> Iterator[str]:
        return iter(STREAMS)

    def __len__(self) -> int:
        return len(STREAMS)

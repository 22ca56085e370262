"""Snapshots kept between runs: digests of all entities in a tree, so a run reads only the parts that changed."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators.diff import ENTITY_KEY, UNCHANGED, EmptySnapshotError, compared, fingerprints
from lodestone.session import shared_folder
from lodestone.sinks.commits import CommitLog

# Rows of a leaf of the tree and of a file, about; both numbers are kept as powers of two of parts.
LEAF_ROWS, SHARD_ROWS = 16_384, 262_144
# So many shards are named in a filter.
LISTED_SHARDS = 10_000
GROUP = ("connection_qn", "typeName")
KEYS = "connection_qn string, typeName string, qualifiedName string, h1 long, h2 long, spread int, bucket int, shard int"


def _power_of_two(at_least: Column) -> Column:
    return F.pow(F.lit(2), F.ceil(F.log2(F.greatest(at_least, F.lit(1.0))))).cast("int")


def _bucket(spread: Column) -> Column:
    return F.pmod(F.xxhash64("qualifiedName"), spread).cast("int")


def _digests(rows: str) -> list[Column]:
    """Of a set of rows, whatever their order: exclusive or of two hashes of each."""
    return [F.bit_xor(F.xxhash64(F.lit(salt), F.col("qualifiedName"), F.col("h1"), F.col("h2"))).alias(f"{rows}{salt}") for salt in (1, 2)]


@dataclass(frozen=True)
class Version:
    """A published snapshot: its number, and the folder that holds its keys, its tree and its changes against the one before."""

    number: int
    folder: str


class SnapshotStore:
    """Versions of a snapshot below `root`.

    A version has one row for each entity and content (`keys`): connection, type, qualified name, two hashes. A connection's
    entities of a type are dealt by name over `spread` leaves, a power of two, so that a leaf of a smaller spread is the union of
    some of a larger one, and its digest their exclusive or; that is what makes the leaves a tree although only they are stored. Leaves are
    dealt over shards, each a directory, so that directories without a changed leaf are not read.

    A version is written aside and becomes the current one by a single rename at the end; a run that stops earlier changes nothing
    for readers, and its folder is never looked at again. Two runs at a time: the second to finish fails.
    """

    def __init__(self, spark: SparkSession, root: str, leaf_rows: int = LEAF_ROWS, shard_rows: int = SHARD_ROWS) -> None:
        self._spark, self._root = spark, root.rstrip("/")
        self._log = CommitLog(spark, f"{self._root}/log")
        self._leaf_rows, self._shard_rows = leaf_rows, shard_rows

    # ---- reading ---------------------------------------------------------------------------------------------

    def current(self) -> Version | None:
        found = self._log.latest()
        return Version(found[0], found[1]["folder"]) if found else None

    def keys(self, version: Version) -> DataFrame:
        return self._spark.read.schema(KEYS).parquet(f"{version.folder}/keys")

    def tree(self, version: Version) -> DataFrame:
        return self._spark.read.parquet(f"{version.folder}/tree")

    def changes(self, version: Version) -> DataFrame:
        """What `version` changed: ENTITY_KEY and insert, update or archive."""
        return self._spark.read.schema(", ".join(f"{c} string" for c in (*ENTITY_KEY, "change"))).parquet(f"{version.folder}/changes")

    # ---- comparing -------------------------------------------------------------------------------------------

    def _changed_nodes(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """Nodes (connection, type, spread, node) at which the trees differ, each group at the smaller of its two spreads."""
        sides = [t.withColumn("is_new", F.lit(is_new)) for t, is_new in ((old, False), (new, True))]
        both = sides[0].unionByName(sides[1])
        common = both.groupBy(*GROUP).agg(F.min("spread").alias("common"))
        nodes = both.join(common, list(GROUP)).withColumn("node", F.col("bucket") % F.col("common"))
        values = ["entities", "leaf1", "leaf2"]
        combine = {"entities": F.sum, "leaf1": F.bit_xor, "leaf2": F.bit_xor}
        sums = [combine[v](F.when(F.col("is_new") == is_new, F.col(v))).alias(f"{v}_{is_new}") for v in values for is_new in (False, True)]
        same = reduce(Column.__and__, [F.col(f"{v}_False").eqNullSafe(F.col(f"{v}_True")) for v in values])
        return nodes.groupBy(*GROUP, "common", "node").agg(*sums).where(~same).select(*GROUP, "common", "node")

    def _rows_below(self, version: Version, nodes: DataFrame) -> DataFrame:
        """The key rows below the nodes."""
        leaves = self.tree(version).join(nodes, list(GROUP)).where(F.col("bucket") % F.col("common") == F.col("node"))
        return self._rows_of(version, leaves)

    def _rows_of(self, version: Version, leaves: DataFrame) -> DataFrame:
        """The key rows of some leaves. Shards that hold one are named in the filter, so no file of others is opened; where very many
        are, there is little to leave out, and all are read."""
        shards = [row["shard"] for row in leaves.select("shard").distinct().limit(LISTED_SHARDS + 1).collect()]
        rows = self.keys(version)
        if len(shards) <= LISTED_SHARDS:
            rows = rows.where(F.col("shard").isin(shards))
        return rows.join(leaves.select(*GROUP, "shard", "bucket"), [*GROUP, "shard", "bucket"], "left_semi")

    def changes_between(self, old: Version, new: Version, nodes: DataFrame) -> DataFrame:
        """The changed entities below the nodes, as the diff of the two whole snapshots has them."""
        sides = [self._rows_below(version, nodes).withColumn("is_new", F.lit(is_new)) for version, is_new in ((old, False), (new, True))]
        return compared(sides[0].unionByName(sides[1])).where(F.col("change") != UNCHANGED)

    # ---- writing ---------------------------------------------------------------------------------------------

    def _save(self, df: DataFrame, path: str, by: Sequence[str] = ()) -> DataFrame:
        df.write.partitionBy(*by).parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def _placed(self, rows: DataFrame, groups: DataFrame, shards: int) -> DataFrame:
        """Rows with their leaf and shard, from the spread of their group."""
        placed = rows.join(groups, list(GROUP)).withColumn("bucket", _bucket(F.col("spread")))
        shard = F.pmod(F.xxhash64(*GROUP) + F.col("bucket"), F.lit(shards)).cast("int")
        return placed.withColumn("shard", shard)

    def publish(self, streams: Sequence[DataFrame]) -> Version:
        """Make the entities of `streams` the current version, and return it once it is.

        Connections of which nothing was delivered keep what they had. A delivery of nothing at all is refused where there is
        a version, as it would archive everything.
        """
        before = self.current()
        number = before.number + 1 if before else 1
        folder = f"{self._root}/versions/{number:012d}-{uuid.uuid4().hex}"
        hashed = reduce(DataFrame.unionByName, [fingerprints(df) for df in streams]).distinct()
        delivered = self._save(hashed, f"{folder}/delivered")
        counted = delivered.groupBy(*GROUP).agg(F.count("*").alias("n"))
        groups = self._save(counted.select(*GROUP, "n", _power_of_two(F.col("n") / self._leaf_rows).alias("spread")), f"{folder}/groups")
        total = groups.agg(F.sum("n")).first()[0]
        if before and not total:
            raise EmptySnapshotError("the new snapshot is empty; nothing is published")
        rows, spreads = delivered, groups.select(*GROUP, "spread")
        if before:
            # Of connections with nothing new, the rows as they were, from the shards that hold some.
            connections = groups.select("connection_qn").distinct()
            kept = self.tree(before).join(connections, "connection_qn", "left_anti")
            kept = self._save(kept, f"{folder}/kept")
            total += kept.agg(F.coalesce(F.sum("entities"), F.lit(0))).first()[0]
            rows = rows.unionByName(self._rows_of(before, kept).select(*rows.columns))
            spreads = spreads.unionByName(kept.select(*GROUP, "spread").distinct())
        shards = 1 << ((total or 0) // self._shard_rows).bit_length()
        placed = self._placed(rows, spreads, shards).repartition("shard").select(*(c.split()[0] for c in KEYS.split(", ")))
        placed.write.partitionBy("shard").parquet(f"{folder}/keys")
        version = Version(number, folder)
        leaves = self.keys(version).groupBy(*GROUP, "spread", "bucket", "shard").agg(F.count("*").alias("entities"), *_digests("leaf"))
        tree = self._save(leaves, f"{folder}/tree")
        if before:
            mine = tree.join(groups.select("connection_qn").distinct(), "connection_qn", "left_semi")
            old = self.tree(before).join(groups.select("connection_qn").distinct(), "connection_qn", "left_semi")
            nodes = self._save(self._changed_nodes(old, mine), f"{folder}/nodes")
            changed = self.changes_between(before, version, nodes)
        else:
            changed = compared(self.keys(version).withColumn("is_new", F.lit(True)))
        changed.write.parquet(f"{folder}/changes")
        self._log.commit(number, {"folder": folder, "entities": total or 0, "shards": shards})
        return version


def stored_extract(spark: SparkSession, entities: DataFrame) -> DataFrame:
    """Entities written once, and read back wherever they are used: a run reads its entities to store their digests and again to
    publish those that changed, and need not extract them for each."""
    path = shared_folder(spark, "extract")
    entities.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(entities.schema).parquet(path)


def changed_only(entities: DataFrame, changes: DataFrame) -> DataFrame:
    """Of `entities`, those that a version's changes insert or update, complete, ready to be delivered again."""
    wanted = changes.where(F.col("change").isin("insert", "update")).select(*ENTITY_KEY)
    keyed = entities.withColumn("qualifiedName", F.col("attributes.qualifiedName"))
    return keyed.join(wanted, list(ENTITY_KEY), "left_semi").select(*entities.columns)

"""Approximate nearest neighbours by collision counting: single projections in sorted arrays, windows around the query."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.embedding_dedup import usable
from lodestone.llm.scratch import Scratch, ship
from lodestone.llm.topk import first_rows

NEAREST = 10
EVERY = 100
# A vector at distance R falls into a window of half width R in 68 % of the projections, so it collides in `COLLISIONS` of them
# (two standard deviations less) with a chance of 97 %; one a quarter farther does in one case of three.
PROJECTIONS = 96
INSIDE = math.erf(1 / math.sqrt(2))
COLLISIONS = math.ceil(PROJECTIONS * INSIDE - 2 * math.sqrt(PROJECTIONS * INSIDE * (1 - INSIDE)))
# Windows start at a part of the query's bound and widen by this factor.
NARROWEST, WIDEN = 1 / 8, math.sqrt(2)
# Rows whose nearest neighbours bound each query's radius; of all rows, whatever their number, the first by hash.
SAMPLE = 4_096
# Vectors of a chunk with sorted arrays of its own, and queries that one pass over all vectors answers.
CHUNK, LEAST_CHUNK, BLOCK = 32_768, 4_096, 8_192
SEED = 29


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors: their rows, and they themselves in double precision."""
    lengths = np.array(column.value_lengths())
    values = np.array(column.flatten()).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        yield rows, values[starts[rows][:, None] + np.arange(size)]


def distances(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of `x`; differences are scaled first where their squares leave the range of doubles."""
    off = np.abs(x - query)
    with np.errstate(over="ignore", under="ignore"):
        found = np.sqrt((off * off).sum(axis=1))
    odd = ~np.isfinite(found) | (found < 1e-140)
    if odd.any():
        largest = off[odd].max(axis=1)
        scale = np.where((largest > 0) & np.isfinite(largest), largest, 1.0)
        found[odd] = np.sqrt(((off[odd] / scale[:, None]) ** 2).sum(axis=1)) * scale
    return found


def _bounds(sample: list[tuple[int | None, np.ndarray]], k: int) -> Callable:
    """Adds to queries (vec_id, embedding) the distance to the `k`-th nearest other vector of the sample, or infinity."""

    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, bounds = part.column(0).to_pylist(), np.full(part.num_rows, np.inf)
            for rows, x in _vectors(part.column(1)):
                some = [(i, v) for i, v in sample if len(v) == x.shape[1]]
                if len(some) > k:
                    others = np.array([v for _, v in some])
                    names = np.array([np.iinfo(np.int64).min if i is None else i for i, _ in some])
                    for row, query in zip(rows, x, strict=True):
                        far = distances(others, query)[names != ids[row]]
                        bounds[row] = np.partition(far, k - 1)[k - 1] if len(far) >= k else np.inf
            yield pa.record_batch([part.column(0), part.column(1), pa.array(bounds)], ["vec_id", "embedding", "bound"])

    return found


class Index:
    """Vectors of one length, and for each projection their order by it."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, scale: float) -> None:
        self.ids, self.x, self.scale = ids, x, scale
        self.axes = np.random.default_rng([SEED, x.shape[1]]).normal(size=(x.shape[1], PROJECTIONS))
        placed = (x / scale) @ self.axes
        self.order = np.argsort(placed, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.take_along_axis(placed.T, self.order, axis=1)

    def windows(self, at: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each query's window begins and ends in each projection's array."""
        low = np.array([np.searchsorted(s, p - half) for s, p in zip(self.sorted, at.T, strict=True)])
        high = np.array([np.searchsorted(s, p + half, side="right") for s, p in zip(self.sorted, at.T, strict=True)])
        return low, high

    def nearest(self, queries: np.ndarray, own: np.ndarray, bounds: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each query's number, with the rows and distances of its `k` nearest here, ties to smaller ids.

        A window holds what projects to within a radius of the query; each round widens it, which joins neighbouring buckets
        of a hash with narrower ones (virtual rehashing), and counts what came in. Rows counted often enough are verified. A query is done
        when `k` verified rows lie within the radius, or the radius reaches the query's bound, or the windows hold all rows.
        """
        size = len(self.x)
        at = (queries / self.scale) @ self.axes
        # Projections of equal vectors may differ in their last digits.
        slack = 1e-9 * np.linalg.norm(queries / self.scale, axis=1)
        reach = bounds / self.scale
        radius = np.where(np.isfinite(reach), reach * NARROWEST, np.inf)
        counts = np.zeros((len(queries), size), np.uint8)
        low = high = np.array([np.searchsorted(s, p) for s, p in zip(self.sorted, at.T, strict=True)])
        near = [(np.zeros(0, np.int64), np.zeros(0)) for _ in queries]
        open_queries = np.arange(len(queries))
        while len(open_queries):
            half = radius[open_queries] + slack[open_queries]
            to_low, to_high = self.windows(at[open_queries], half)
            still = []
            for place, q in enumerate(open_queries):
                came = [o[a:b] for o, a, b in zip(self.order, to_low[:, place], low[:, place], strict=True)]
                came += [o[a:b] for o, a, b in zip(self.order, high[:, place], to_high[:, place], strict=True)]
                before = counts[q]
                now = before + np.bincount(np.concatenate(came), minlength=size).astype(np.uint8)
                new = np.flatnonzero((now >= COLLISIONS) & (before < COLLISIONS))
                counts[q] = now
                new = new[self.ids[new] != own[q]]
                rows = np.append(near[q][0], new)
                far = np.append(near[q][1], distances(self.x[new], queries[q]))
                top = np.lexsort((self.ids[rows], far))[:k]
                near[q] = rows[top], far[top]
                enough = len(top) == k and far[top[-1]] <= radius[q] * self.scale
                if not (enough or radius[q] >= reach[q] or (to_high[:, place] - to_low[:, place] == size).all()):
                    still.append(place)
            done = np.setdiff1d(np.arange(len(open_queries)), still)
            for q in open_queries[done]:
                yield int(q), *near[q]
            low, high = to_low[:, still], to_high[:, still]
            open_queries = open_queries[still]
            radius[open_queries] = np.minimum(radius[open_queries] * WIDEN, reach[open_queries])


def _search(queries: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], k: int, scale: float, chunk: int) -> Callable:
    """For vectors (vec_id, embedding), each query's nearest of every chunk: query_id, vec_id, score."""
    none = np.iinfo(np.int64).max

    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _chunks(parts, chunk):
            names = some.column(0).combine_chunks()
            ids = np.array(names.fill_null(none))
            for rows, x in _vectors(some.column(1).combine_chunks()):
                if x.shape[1] not in queries:
                    continue
                own, vectors, bounds = queries[x.shape[1]]
                index = Index(ids[rows], x, scale)
                # Counts take a byte a query and vector, so some queries go together.
                for at in range(0, len(own), 512):
                    part = slice(at, at + 512)
                    asked, places, scores = [], [], []
                    for q, near, far in index.nearest(vectors[part], own[part], bounds[part], k):
                        asked += [own[at + q]] * len(near)
                        places.append(rows[near])
                        scores.append(far)
                    columns = [pa.array(asked, pa.int64()), names.take(pa.array(np.concatenate(places))), pa.array(np.concatenate(scores))]
                    yield pa.record_batch(columns, ["query_id", "vec_id", "score"])

    return found


def _chunks(parts: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for part in parts:
        for at in range(0, part.num_rows, 1024):
            held.append(part.slice(at, 1024))
            if sum(h.num_rows for h in held) >= chunk:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def nearest(vectors: DataFrame, queries: DataFrame, scratch: Scratch, k: int = NEAREST, block: int = BLOCK, chunk: int = CHUNK, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each of `queries` (vec_id, embedding) the `k` nearest rows found of `vectors` (the same),
    by Euclidean distance in double precision, nearest first, ties to the smaller vec_id (null last).

    Rows with the query's own id are left out. Vectors that are null, empty, zero or hold null or non-finite components take no
    part, and vectors of other lengths are not compared. Repeated rows are candidates each; of several vectors of one query id
    the first in order of its values is asked for, and a null id asks nothing. A query with fewer candidates gets all. No rows give
    none. Other columns are not read.

    Every row is searched: vectors are dealt into chunks of up to `chunk`, each with sorted arrays of its own. The distance to the
    `k`-th nearest row of a `sample` bounds how far a query's windows widen; all nearer rows have collided by then, each with the
    chance said above. Queries go in blocks of `block`, each a pass over all vectors; a block and the sample are what tasks and
    the driver hold.
    """
    spark = vectors.sparkSession
    ship(spark)

    def fine(rows: DataFrame) -> DataFrame:
        return rows.where(usable("embedding")).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))

    rows = fine(vectors)
    largest = F.array_max(F.transform("embedding", lambda v: F.abs(v)))
    count, scale = rows.agg(F.count("*"), F.max(largest)).first()
    out = "query_id long, vec_id long, score double"
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    some = rows.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id", "embedding").limit(sample).collect()
    bounds = _bounds([(r["vec_id"], np.array(r["embedding"])) for r in some], k)
    asked = fine(queries).where("vec_id is not null").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = asked.mapInArrow(bounds, "vec_id long, embedding array<double>, bound double")
    asked = scratch.save(asked, "queries")
    blocks = math.ceil(asked.count() / block)
    # Dealt round-robin, so blocks are even whatever the ids.
    dealt = scratch.save(asked.repartition(max(1, blocks)).withColumn("block", F.spark_partition_id()), "blocks")
    cores = spark.sparkContext.defaultParallelism
    parts = max(math.ceil(count / chunk), min(cores, math.ceil(count / LEAST_CHUNK)))
    rows = rows.repartition(parts)
    if blocks > 1:
        rows = scratch.save(rows, "vectors")
    found = []
    for number in range(blocks):
        of_size: dict[int, list] = {}
        for r in dealt.where(F.col("block") == number).collect():
            of_size.setdefault(len(r["embedding"]), []).append(r)
        packed = {
            size: (np.array([r["vec_id"] for r in q]), np.array([r["embedding"] for r in q]), np.array([r["bound"] for r in q]))
            for size, q in of_size.items()
        }
        best = rows.mapInArrow(_search(packed, k, scale, chunk), out)
        found.append(scratch.save(best, f"found{number}"))
    together = spark.createDataFrame([], out)
    for more in found:
        together = together.unionByName(more)
    order = [F.asc("score"), F.asc_nulls_last("vec_id")]
    return first_rows(together, ["query_id"], order, k).select("query_id", "rank", "vec_id", "score")


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.where(F.col("vec_id") % EVERY == 0), Scratch(spark, "nearest"))

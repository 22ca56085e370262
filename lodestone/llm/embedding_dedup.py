"""Embedding near-duplicates: random projections decoded to E8 lattice points in several tables, cosine verified."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.components import connected_components
from lodestone.llm.scratch import Scratch, ship

COSINE = 0.93
# With these, vectors of cosine 0.93 meet in a table with a chance of about two thirds, unrelated ones of a few thousandths.
TABLES, PROBES, SCALE = 8, 20, 0.8
# Signs of 64 random projections: at cosine 0.93 some 8 differ, with a spread of 2.6; of unrelated vectors 32.
SKETCH_BITS, SKETCH_DIFFERENT = 64, 24
SEED = 17
DIM = 8


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: a point's nearest neighbours are as far from it."""
    found = []
    for i, j in combinations(range(DIM), 2):
        for signs in product((1.0, -1.0), repeat=2):
            found.append(np.zeros(DIM))
            found[-1][[i, j]] = signs
    found += [np.array(h) for h in product((0.5, -0.5), repeat=DIM) if sum(x < 0 for x in h) % 2 == 0]
    return np.array(found)


ROOTS = roots()


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest whole-number points of even sum: where rounding gives an odd one, the worst coordinate goes the other way."""
    near = np.rint(x)
    odd = near.sum(axis=1) % 2 != 0
    off = x - near
    worst = np.abs(off).argmax(axis=1)
    rows = np.flatnonzero(odd)
    near[rows, worst[rows]] += np.where(off[rows, worst[rows]] >= 0, 1, -1)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8 to each row: E8 is the points of even sum and those half a step off them."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def _mixed(points: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit key of each lattice point (last axis) and the salt."""
    odd = np.random.default_rng(SEED).integers(1, 1 << 62, DIM, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    keys = ((points * 2).astype(np.int64).astype(np.uint64) * odd).sum(axis=-1, dtype=np.uint64)
    keys = (keys ^ np.uint64(salt & (1 << 64) - 1)) * np.uint64(0x9E3779B97F4A7C15)
    return (keys ^ (keys >> np.uint64(31))).view(np.int64)


def cells(tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> Callable:
    """For vectors (class_no, a number for the label, embedding), their lattice cells: key, class_no, sketch, own (or a neighbouring cell)."""

    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            numbers, labels = np.array(part.column(0)), np.array(part.column(1))
            vectors = part.column(2)
            lengths = np.array(vectors.value_lengths())
            values = np.array(vectors.flatten()).astype(np.float64)
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            for size in np.unique(lengths):
                rows = np.flatnonzero(lengths == size)
                x = values[starts[rows][:, None] + np.arange(size)]
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                signs = x @ np.random.default_rng([SEED, int(size)]).normal(size=(size, SKETCH_BITS)) > 0
                sketch = np.packbits(signs, axis=1).view(">i8")[:, 0].astype(np.int64)
                for table in range(tables):
                    at = x @ (np.random.default_rng([SEED, int(size), table]).normal(size=(size, DIM)) * scale)
                    own = decode(at)
                    # Distances to the neighbours, less what is the same for all of them.
                    near = np.argsort(2 * (own - at) @ ROOTS.T, axis=1, kind="stable")[:, :probes]
                    points = np.concatenate([own[:, None, :], own[:, None, :] + ROOTS[near]], axis=1)
                    salt = np.array([hash((int(size), table, int(v))) for v in labels[rows]], np.int64).view(np.uint64)
                    keys = (_mixed(points, 0).view(np.uint64) ^ (salt * np.uint64(0xBF58476D1CE4E5B9))[:, None]).view(np.int64)
                    each = probes + 1
                    columns = [keys.ravel(), np.repeat(numbers[rows], each), np.repeat(sketch, each), np.tile(np.arange(each) == 0, len(rows))]
                    yield pa.record_batch([pa.array(c) for c in columns], ["key", "class_no", "sketch", "own"])

    return found


def usable(vector: str) -> Column:
    """Whether a vector has a direction: there, not all zero, no component null, infinite or not a number."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def in_range(vector: str) -> Column:
    """The vector in double precision; where squares of its components would leave the range of doubles, times a power of two, which
    changes no digit of a cosine."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    largest = F.array_max(F.transform(doubles, F.abs))
    scale = F.pow(F.lit(2.0), F.floor(F.log2(largest)).cast("double"))
    return F.when(largest.between(1e-100, 1e100), doubles).otherwise(F.transform(doubles, lambda x: x / scale))


def cosine(a: str, b: str) -> Column:
    def dot(x: str, y: str) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)

    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def close_vectors(classes: DataFrame, scratch: Scratch, least: float = COSINE) -> DataFrame:
    """(a, b): pairs of class_no, a < b, of one label and a cosine of at least `least`, each once."""
    rows = classes.select("class_no", F.xxhash64("label").alias("label"), "embedding").mapInArrow(cells(), "key long, class_no long, sketch long, own boolean")
    rows = scratch.save(rows, "cells")
    base = rows.where("own").select("key", F.col("class_no").alias("a"), F.col("sketch").alias("a_sketch"))
    probing = rows.select(F.col("key").alias("probe"), F.col("class_no").alias("b"), F.col("sketch").alias("b_sketch"))
    different = F.bit_count(F.col("a_sketch").bitwiseXOR(F.col("b_sketch")))
    meet = (F.col("key") == F.col("probe")) & (F.col("a") != F.col("b")) & (different <= SKETCH_DIFFERENT)
    pairs = base.join(probing, meet).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for side in ("a", "b"):
        own = classes.select(F.col("class_no").alias(side), F.col("label").alias(f"{side}_label"), in_range("embedding").alias(f"{side}_vector"))
        pairs = pairs.join(own, side)
    same = (F.col("a_label") == F.col("b_label")) & (F.size("a_vector") == F.size("b_vector"))
    return pairs.where(same).where(cosine("a_vector", "b_vector") >= least).select("a", "b")


def near_vectors(vectors: DataFrame, scratch: Scratch, least: float = COSINE) -> DataFrame:
    """(vec_id, label, n_links, component_id, kept), a row for each row of `vectors` (vec_id, embedding, label).

    Vectors of one label link at a cosine of `least` or more, computed in double precision for every pair that meets in a
    lattice cell, or a neighbouring one, of any table. Equal vectors meet as one class first, so copies cost one row and no
    pairs; n_links counts all other vectors linked, copies and repeated rows included. component_id is the smallest vec_id reachable,
    itself included. Vectors of other lengths, null labels, and vectors that are null, empty, zero or hold null or
    non-finite components link with nothing. A null vec_id counts only where a component has no other. No rows give
    none. Other columns are not read.
    """
    ship(vectors.sparkSession)
    rows = vectors.select("vec_id", "label", "embedding")
    linking = usable("embedding") & F.col("label").isNotNull()
    counted = rows.where(linking).groupBy("label", "embedding").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("size"))
    classes = scratch.save(counted.withColumn("class_no", F.monotonically_increasing_id()), "classes")
    links = scratch.save(close_vectors(classes, scratch, least), "links")
    scratch.drop("cells")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.select(F.col("class_no").alias("b"), "size")
    linked = both.join(sizes, "b").groupBy("a").agg(F.sum("size").alias("linked"))
    parts = connected_components(links, scratch)
    ids = classes.select("class_no", "first_id")
    members = ids.join(parts, ids["class_no"] == parts["node"])
    smallest = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    members = members.join(smallest, "root").select(F.col("class_no").alias("member"), "component_id")
    found = classes.join(members, classes["class_no"] == members["member"], "left")
    found = found.join(linked, found["class_no"] == linked["a"], "left").select(
        F.col("label").alias("own_label"),
        F.col("embedding").alias("own_vector"),
        (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "first_id").alias("component_id"),
    )
    found = scratch.save(found, "found")
    own = rows.where(linking).join(found, (F.col("label") == F.col("own_label")) & (F.col("embedding") == F.col("own_vector")))
    own = own.select("vec_id", "label", "n_links", "component_id")
    alone = rows.where(~linking).select("vec_id", "label", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = own.unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op8_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Scratch(spark, "embedding"))
    return found.select("vec_id", "n_links", "component_id", "kept")

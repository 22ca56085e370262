"""Ranked lexical search: documents grouped by the mask of the item's terms they hold, masks scored from the highest bound down."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from lodestone.llm.scratch import Scratch, documents, ship
from lodestone.llm.topk import first_rows

BEST = 20
# A chunk of documents is closed at either number, which bounds the memory of a task.
CHUNK_DOCS, CHUNK_POSTINGS = 16_384, 2_000_000
# Terms of items that one pass over the documents looks for; more items take more passes.
BLOCK_TERMS = 500_000

# In UTF-8, every byte of a character beyond ASCII is one of a term.
_SEPARATE = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))


def terms(text: str | None) -> list[bytes]:
    """The text's terms in UTF-8: runs of ASCII letters, digits and characters beyond ASCII, only A-Z lower-cased."""
    return [] if text is None else text.encode().translate(_SEPARATE).split()


def _item_terms(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        counted = [Counter(terms(text)) for text in part.column(1).to_pylist()]
        places = np.repeat(np.arange(len(counted)), [len(c) for c in counted])
        words = [t.decode() for c in counted for t in c]
        numbers = [n for c in counted for n in c.values()]
        yield pa.record_batch([part.column(0).take(pa.array(places)), pa.array(words, pa.string()), pa.array(numbers, pa.int64())], ["item_id", "term", "n"])


def _hits(vocabulary: dict[bytes, int]) -> Callable:
    """For documents (doc_id, text): doc_id, number of terms, and the vocabulary's terms in it with their numbers."""

    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes, ends, held, numbers = [], [0], [], []
            for text in part.column(1):
                words = terms(text.as_py())
                sizes.append(len(words))
                for word, n in Counter(words).items():
                    if (term := vocabulary.get(word)) is not None:
                        held.append(term)
                        numbers.append(n)
                ends.append(len(held))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, t)) for v, t in ((held, pa.int32()), (numbers, pa.int64()))]
            yield pa.record_batch([part.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return found


class Chunk:
    """Postings of some documents by term, with what each adds to a score of weight 1, and a bitmap of documents per term."""

    def __init__(self, sizes: np.ndarray, hits: np.ndarray, held: np.ndarray, tfs: np.ndarray, docs: int, words: int) -> None:
        self.size = len(sizes)
        m = 75 + (25 * sizes * docs) // words
        owner = np.repeat(np.arange(self.size), hits)
        order = np.argsort(held, kind="stable")
        self.docs, tf = owner[order], tfs[order]
        self.gain = (1_000_000_000 * tf) // (1000 * tf + 12 * m[self.docs])
        self.terms, starts = np.unique(held[order], return_index=True)
        self.ends = np.append(starts, len(order))
        self.most = np.maximum.reduceat(self.gain, starts) if len(starts) else np.zeros(0, np.int64)
        self.bitmaps = np.zeros((len(self.terms), (self.size + 7) // 8), np.uint8)
        for at in range(0, len(self.terms), 256):
            to = min(at + 256, len(self.terms))
            present = np.zeros((to - at, self.size), bool)
            a, b = self.ends[at], self.ends[to]
            present[np.repeat(np.arange(to - at), np.diff(self.ends[at : to + 1])), self.docs[a:b]] = True
            self.bitmaps[at:to] = np.packbits(present, axis=1)

    def masks(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents holding any of the terms, each one's group, and of each group the terms it holds (groups x terms).
        The terms' bitmaps are turned over, which gives each document's mask."""
        any_of = np.bitwise_or.reduce(self.bitmaps[rows], axis=0)
        some = np.flatnonzero(np.unpackbits(any_of, count=self.size))
        group = np.zeros(len(some), np.int64)
        for at in range(0, len(rows), 32):
            bits = np.unpackbits(self.bitmaps[rows[at : at + 32]], axis=1, count=self.size)[:, some]
            packed = np.packbits(bits, axis=0)
            word = np.zeros(len(some), np.int64)
            for byte in packed:
                word = word << 8 | byte
            group = np.unique(group << 32 | word, return_inverse=True)[1]
        first = np.zeros(group.max(initial=-1) + 1, np.int64)
        first[group] = some
        held = (self.bitmaps[rows][:, first >> 3] >> (7 - (first & 7)) & 1).T
        return some, group, held

    def scores(self, docs: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        total = np.zeros(len(docs), np.int64)
        for row, weight in zip(rows, weights, strict=True):
            a, b = self.ends[row], self.ends[row + 1]
            at = np.minimum(np.searchsorted(self.docs[a:b], docs), b - a - 1)
            total += np.where(self.docs[a:b][at] == docs, self.gain[a:b][at], 0) * weight
        return total

    def best(self, wanted: np.ndarray, weights: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The `k` best documents and their scores, of those above 0; ties to the smaller id.

        All documents of a mask score at most the sum of the most that each of its terms adds in this chunk. Masks are
        scored from the highest such bound down, until `k` documents score more than the next bound."""
        at = np.searchsorted(self.terms, wanted)
        there = at < len(self.terms)
        there[there] = self.terms[at[there]] == wanted[there]
        rows, weights = at[there], weights[there]
        rows, weights = rows[weights > 0], weights[weights > 0]
        none = np.zeros(0, np.int64)
        if not len(rows):
            return none, none
        some, group, held = self.masks(rows)
        bounds = held.astype(np.int64) @ (weights * self.most[rows])
        order = np.argsort(-bounds, kind="stable")
        by_rank = np.empty_like(order)
        by_rank[order] = np.arange(len(order))
        rank = by_rank[group]
        in_order = np.argsort(rank, kind="stable")
        some, last = some[in_order], np.cumsum(np.bincount(rank, minlength=len(order)))
        docs, scores, done, step = none, none, 0, 4 * k
        while done < len(some):
            # Whole masks, some documents at a time.
            to = last[np.searchsorted(last, min(done + step, len(some)))]
            new = some[done:to]
            docs, scores = np.append(docs, new), np.append(scores, self.scores(new, rows, weights))
            top = np.lexsort((ids[docs], -scores))[:k]
            docs, scores = docs[top], scores[top]
            done, step = to, 2 * step
            if done < len(some) and len(docs) == k and scores[-1] > bounds[order[np.searchsorted(last, done, side="right")]]:
                break
        return docs[scores > 0], scores[scores > 0]


def _search(items: list[tuple], total_docs: int, total_words: int, item_type: pa.DataType, k: int, chunk_docs: int) -> Callable:
    """For documents (doc_id, n, terms, tfs), each item's best of every chunk: item_id, doc_id, score."""

    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in _chunks(parts, chunk_docs):
            ids = docs.column("doc_id").combine_chunks()
            held, tfs = (docs.column(c).combine_chunks() for c in ("terms", "tfs"))
            hits = np.array(held.value_lengths())
            chunk = Chunk(np.array(docs.column("n")), hits, np.array(held.flatten()), np.array(tfs.flatten()), total_docs, total_words)
            order = np.array(ids.fill_null(np.iinfo(np.int64).max))
            names, places, scores = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for item, wanted, weights in items:
                at, score = chunk.best(wanted, weights, order, k)
                names += [item] * len(at)
                places.append(at)
                scores.append(score)
            rows = [pa.array(names, item_type), ids.take(pa.array(np.concatenate(places))), pa.array(np.concatenate(scores))]
            yield pa.record_batch(rows, ["item_id", "doc_id", "score"])

    return found


def _chunks(parts: Iterator[pa.RecordBatch], chunk_docs: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    docs = postings = 0
    for part in parts:
        for at in range(0, part.num_rows, 1024):
            some = part.slice(at, 1024)
            held.append(some)
            docs, postings = docs + some.num_rows, postings + len(some.column(2).flatten())
            if docs >= chunk_docs or postings >= CHUNK_POSTINGS:
                yield pa.Table.from_batches(held)
                held, docs, postings = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def ranked(docs: DataFrame, items: DataFrame, scratch: Scratch, k: int = BEST, block_terms: int = BLOCK_TERMS, chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` best documents of `docs` (doc_id, text) for each item of `items` (item_id, text).

    Scores are whole numbers: the weights of an item's terms, repeats included, times how full the document is of them; only
    scores above 0 count, ties go to the smaller doc_id (null last). Documents are cut into chunks, and in each chunk the
    documents of one item are grouped by the mask of its terms they hold. Each row of `docs` is a document, also where ids
    repeat; null and empty texts have no terms. Different texts of one item_id are one item, equal ones count once, null is an
    id; an item without terms has no rows. No documents or no items give none. Other columns are not read.

    A pass over the documents looks for the terms of one block of items, `block_terms` on average, which is what its tasks and the
    driver hold at a time; texts of any number of items are searched, in as many passes.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = items.schema["item_id"].dataType
    wanted = items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    wanted = wanted.mapInArrow(_item_terms, f"item_id {kind.simpleString()}, term string, n long")
    wanted = scratch.save(wanted.groupBy("item_id", "term").agg(F.sum("n").alias("n")), "items")
    blocks = max(1, math.ceil(wanted.count() / block_terms))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = [spark.createDataFrame([], f"item_id {kind.simpleString()}, doc_id long, score long")]
    for number in range(blocks):
        rows = wanted.where(block == number).collect()
        vocabulary = {t.encode(): i for i, t in enumerate(sorted({r["term"] for r in rows}))}
        if vocabulary:
            found.append(_of_block(texts, rows, vocabulary, kind, k, chunk_docs, scratch, number))
    together = found[0]
    for more in found[1:]:
        together = together.unionByName(more)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    return first_rows(together, ["item_id"], order, k).select("item_id", "rank", "doc_id", "score")


def _of_block(
    texts: DataFrame, rows: list[Row], vocabulary: dict[bytes, int], kind: DataType, k: int, chunk_docs: int, scratch: Scratch, number: int
) -> DataFrame:
    hits = texts.mapInArrow(_hits(vocabulary), "doc_id long, n long, terms array<int>, tfs array<long>")
    hits = scratch.save(hits.where("n > 0"), f"hits{number}")
    docs, words = hits.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    counted = hits.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    # A row a term of this block at most.
    weights = {r["term"]: _weight(docs, r["df"]) for r in counted.collect()}
    items: dict = {}
    for row in rows:
        term = vocabulary[row["term"].encode()]
        if term in weights:
            items.setdefault(row["item_id"], []).append((term, row["n"] * weights[term]))
    lists = [(item, np.array([t for t, _ in some]), np.array([w for _, w in some], np.int64)) for item, some in items.items()]
    search = _search(lists, docs, words, to_arrow_type(kind), k, chunk_docs)
    return scratch.save(hits.where(F.size("terms") > 0).mapInArrow(search, f"item_id {kind.simpleString()}, doc_id long, score long"), f"best{number}")


LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALL_TERMS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11_SQL = f"""
with d as (select row_number() over () as r, doc_id, {ALL_TERMS} as ts from documents where text is not null),
sizes as (select r, doc_id, len(ts) as n from d where len(ts) > 0),
total as (select count(*) as docs, sum(n)::bigint as words from sizes),
q as (
    select item_id, term, count(*) as times
    from (select item_id, unnest({ALL_TERMS}) as term from (select distinct item_id, text from benchmark)) group by all
),
p as (select r, term, count(*) as tf from (select r, unnest(ts) as term from d) where term in (select term from q) group by all),
w as (select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)))::bigint as weight from p, total group by term),
s as (
    select item_id, r, doc_id,
        sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))))::bigint as score
    from q join w using (term) join p using (term) join sizes using (r), total group by all
)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id nulls last))::int as rank, doc_id, score
from s where score > 0 qualify rank <= {BEST}
"""


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return ranked(documents(spark, sf_dir), items, Scratch(spark, "ranked"))

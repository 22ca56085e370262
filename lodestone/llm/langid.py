"""Language identification by mixtures: expectation-maximisation over n-gram likelihoods, the set of languages by penalty."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.scratch import Scratch, documents, ship

# Rows of each language to learn from, on average at most, chosen by a hash of the id.
TRAIN_ROWS = 2_000
BUCKETS = 1 << 15
# As many n-grams or more are counted in all buckets, fewer are sorted.
SORTED = 1 << 12
SMOOTHING = 0.5
ROUNDS = 25
UNKNOWN = "und"
SPACE = 32


def codes(text: str) -> np.ndarray:
    """The buckets of the text's n-grams of 1 to 3 letters; runs of anything but letters count as one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letters = points >= 128
    small = points[~letters]
    letters[~letters] = (small >= 97) & (small <= 122)
    # Beyond ASCII, Unicode's letters are looked up once for each character that occurs.
    if letters.any():
        found = np.unique(points[letters])
        other = found[[not chr(p).isalpha() for p in found.tolist()]]
        if len(other):
            letters &= ~np.isin(points, other)
    points = np.where(letters, points, SPACE).astype(np.uint64)
    keep = letters.copy()
    keep[1:] |= letters[:-1]
    points = np.concatenate([[np.uint64(SPACE)], points[keep]])
    if not letters.any():
        return np.empty(0, np.int64)
    pairs = points[:-1] * np.uint64(0x1F0000) + points[1:]
    triples = points[:-2] * np.uint64(0x9E3779B97F4A7C15) + pairs[1:] if len(points) > 2 else points[:0]
    grams = np.concatenate([points[1:] + np.uint64(1 << 42), pairs + np.uint64(1 << 43), triples])
    grams = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    # BUCKETS is a power of two.
    return ((grams ^ (grams >> np.uint64(32))) & np.uint64(BUCKETS - 1)).view(np.int64)


@dataclass
class Model:
    """Languages in order, and the log likelihood of each bucket in each: BUCKETS x languages numbers, no more."""

    languages: list[str]
    logs: np.ndarray

    def mixture(self, text: str | None) -> np.ndarray:
        """The text's proportions of the languages; all 0 if it has no letter.

        With a set of languages, the proportions of highest likelihood are found by expectation-maximisation over the
        text's n-grams. Each language costs half the log of the number of n-grams; the set is reduced, the smallest
        proportion first, as long as the penalised likelihood does not fall.
        """
        grams = codes(text or "")
        out = np.zeros(len(self.languages))
        if not len(grams) or not self.languages:
            return out
        buckets, counts = np.unique(grams, return_counts=True) if len(grams) < SORTED else _counted(grams)
        # A row for each language, in double precision once for all rounds.
        logs = np.ascontiguousarray(self.logs[buckets].T)
        likely, counts = np.exp(logs - logs.max(axis=0)).astype(np.float64), counts.astype(np.float64)
        total = counts.sum()
        penalty = 0.5 * np.log(total + 1)
        chosen = np.arange(len(self.languages))
        share, value = _em(likely, counts, total)
        while len(chosen) > 1:
            keep = np.delete(np.arange(len(chosen)), share.argmin())
            fewer, lower = _em(likely[keep], counts, total)
            if lower + penalty < value:
                break
            likely, chosen, share, value = likely[keep], chosen[keep], fewer, lower
        out[chosen] = share
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of the largest proportion (ties: the first by name), and the proportion."""
        shares = self.mixture(text)
        if not shares.any():
            return UNKNOWN, 0.0
        best = int(shares.argmax())
        return self.languages[best], min(1.0, float(shares[best]))


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.bincount(grams, minlength=BUCKETS)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets]


def _em(likely: np.ndarray, counts: np.ndarray, total: float) -> tuple[np.ndarray, float]:
    """Proportions of highest likelihood, and the log likelihood; `likely` has a row for each language."""
    share = np.full(len(likely), 1 / len(likely))
    if len(share) == 1:
        return share, float(counts @ np.log(likely[0] + 1e-300))
    # Texts are short and rounds many, so that numpy's calls are what costs: few of them, into arrays made once.
    part, mixed = counts / total, np.empty(len(counts))
    for _ in range(ROUNDS):
        np.dot(share, likely, out=mixed)
        np.add(mixed, 1e-300, out=mixed)
        np.divide(part, mixed, out=mixed)
        after = np.dot(likely, mixed)
        after *= share
        after /= np.add.reduce(after)
        share -= after
        moved = np.maximum.reduce(np.abs(share, out=share))
        share = after
        if moved < 1e-4:
            break
    return share, float(counts @ np.log(share @ likely + 1e-300))


def learn_model(docs: DataFrame, scratch: Scratch, learn: Column | None = None) -> Model:
    """Smoothed n-gram frequencies of each language, from a bounded sample of rows with lang that `learn` allows. The model has 128 KB
    a language, and the driver gets one row of each."""
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & (F.lit(True) if learn is None else learn))
    known = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    languages = sorted(r["lang"] for r in known)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)))
    # A share of each language's rows that gives TRAIN_ROWS on average; hashes of ids don't favour any.
    part = F.create_map(*[F.lit(v) for r in known for v in (r["lang"], min(1.0, TRAIN_ROWS / r["n"]))])
    place = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1_000_000)) / 1_000_000
    sample = rows.where(place < part[F.col("lang")]).select("lang", "text")

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[str, np.ndarray] = {}
        for part in parts:
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                counts = table.setdefault(lang, np.zeros(BUCKETS, np.int64))
                counts += np.bincount(codes(text or ""), minlength=BUCKETS)
        for lang, counts in table.items():
            seen = np.flatnonzero(counts)
            yield pa.record_batch(
                [pa.array([lang] * len(seen)), pa.array(seen), pa.array(counts[seen])], ["lang", "bucket", "n"]
            )

    grams = sample.mapInArrow(counted, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((BUCKETS, len(languages)))
    place_of = {lang: i for i, lang in enumerate(languages)}
    # At most BUCKETS pairs a language.
    by_language = scratch.save(grams, "grams").groupBy("lang").agg(F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("ns"))
    for row in by_language.toLocalIterator():
        counts[row["buckets"], place_of[row["lang"]]] = row["ns"]
    counts += SMOOTHING
    return Model(languages, np.log(counts / counts.sum(axis=0)).astype(np.float32))


def languages(docs: DataFrame, scratch: Scratch, learn: Column | None = None) -> DataFrame:
    """(doc_id, lang_pred, score, mixture), a row for each row of `docs`; mixture maps languages to their proportions.

    Predictions see whole texts and nothing else. `und` with score 0 and no mixture if the text is null, empty or without any
    letter, or if nothing could be learned. Rows without lang or doc_id are predicted like others. Repeated
    rows get the same result. No rows give none. Other columns are not read.
    """
    ship(docs.sparkSession)
    model = learn_model(docs, scratch, learn)

    @F.pandas_udf("lang_pred string, score double, mixture map<string, double>")
    def of_texts(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for text in batch:
                shares = model.mixture(text)
                if shares.any():
                    best = int(shares.argmax())
                    mixture = {model.languages[i]: float(shares[i]) for i in np.flatnonzero(shares)}
                    rows.append((model.languages[best], min(1.0, float(shares[best])), mixture))
                else:
                    rows.append((UNKNOWN, 0.0, {}))
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "mixture"])

    return docs.select("doc_id", of_texts("text").alias("found")).select("doc_id", "found.*")


def fold(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % folds


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = languages(documents(spark, sf_dir), Scratch(spark, "language"), fold(3) != 1)
    held_out = F.coalesce(fold(3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")

"""Toxicity: terms learned from labels, misspellings by Levenshtein automata over their trie, and scored contexts."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.scratch import Scratch, documents, ship

# The labelled rows to learn from: at most so many of each label, chosen by a hash of the id. Every fifth calibrates.
TOXIC_ROWS, CLEAN_ROWS, CALIBRATE = 8_000, 32_000, 5
SHORTEST_MISSPELT, MISSPELT_WEIGHT = 5, 0.5
WINDOW = 12
WORD = re.compile(r"[^\W_]+")
WORD_JVM = r"[\p{L}\p{N}]+"
QUOTES = (('"', '"'), ("“", "”"), ("„", "“"), ("«", "»"), ("‘", "’"))
QUOTE_REACH = 60
# Words near a term that say it is reported or discussed, and words that say somebody is addressed.
REPORTING = frozenset(
    "said says wrote writes called quote quoted quotes term word words phrase means sagte schrieb nannte wort zitat "
    "dit écrit appelé mot citation dijo escribió llamó palabra cita".split()
)
ADDRESSING = frozenset("you your yours u ur du dich dir dein euch tu te toi ton votre vous tú ti tus usted ustedes".split())
KEPT_WORDS = 150_000


def build_trie(terms: list[str]) -> dict:
    """Nested dicts by character; a term stands under the empty string where it ends."""
    root: dict = {}
    for term in terms:
        node = root
        for letter in term:
            node = node.setdefault(letter, {})
        node[""] = term
    return root


class Automaton:
    """The Levenshtein automaton of `word` for at most `most` edits. A state holds, for each prefix of the word, the edits
    to it, cut off at most + 1; steps are made when first asked for and kept."""

    def __init__(self, word: str, most: int) -> None:
        self.word, self.most = word, most
        self.start = tuple(min(i, most + 1) for i in range(len(word) + 1))
        self._steps: dict[tuple, tuple] = {}

    def step(self, state: tuple, letter: str) -> tuple:
        if (state, letter) not in self._steps:
            row = [min(state[0] + 1, self.most + 1)]
            for i, own in enumerate(self.word):
                row.append(min(state[i] + (own != letter), state[i + 1] + 1, row[i] + 1, self.most + 1))
            self._steps[state, letter] = tuple(row)
        return self._steps[state, letter]

    def alive(self, state: tuple) -> bool:
        return min(state) <= self.most

    def accepts(self, state: tuple) -> bool:
        return state[-1] <= self.most


def close_terms(word: str, trie: dict, most: int = 1) -> list[tuple[str, int]]:
    """The terms of the trie within `most` edits of `word`: the paths that trie and automaton both accept."""
    automaton = Automaton(word, most)
    found, open_paths = [], [(trie, automaton.start)]
    while open_paths:
        node, state = open_paths.pop()
        for letter, below in node.items():
            if letter == "":
                if automaton.accepts(state):
                    found.append((below, state[-1]))
            elif automaton.alive(after := automaton.step(state, letter)):
                open_paths.append((below, after))
    return sorted(found, key=lambda x: (x[1], x[0]))


@dataclass
class Matcher:
    """Finds the words of a text that are terms or misspell one."""

    weights: dict[str, float]
    ordinary: frozenset[str] = frozenset()
    trie: dict = field(default_factory=dict)
    heads: dict[int, set[str]] = field(default_factory=dict)
    tails: dict[int, set[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        long = [t for t in self.weights if len(t) >= SHORTEST_MISSPELT]
        self.trie = build_trie(long)
        # With one edit, the first or the last half of a term stands unchanged at that end of the word.
        for term in long:
            half = len(term) // 2
            self.heads.setdefault(half, set()).add(term[:half])
            self.tails.setdefault(len(term) - half, set()).add(term[half:])
        self._longest = max(map(len, long), default=0)
        self._found: dict[str, float] = {}
        self._none: set[str] = set()

    def __reduce__(self):
        return Matcher, (self.weights, self.ordinary)

    def misspells(self, word: str) -> list[tuple[str, int]]:
        # A word that is longer than every term by more than the one edit is near none.
        if not SHORTEST_MISSPELT - 1 <= len(word) <= self._longest + 1 or not (
            any(word[:n] in heads for n, heads in self.heads.items())
            or any(word[-n:] in tails for n, tails in self.tails.items())
        ):
            return []
        return close_terms(word, self.trie)

    def of(self, words: set[str]) -> dict[str, float]:
        """The weight of each word that counts. What a word is worth is kept, for a bounded number of words."""
        if len(self._none) > KEPT_WORDS:
            self._none = set()
        found = {}
        for word in words - self._none:
            weight = self._found.get(word)
            if weight is None:
                weight = self.weights.get(word, 0.0)
                if not weight and word not in self.ordinary and (close := self.misspells(word)):
                    weight = MISSPELT_WEIGHT * max(self.weights[t] for t, _ in close)
                if not weight:
                    self._none.add(word)
                    continue
                if len(self._found) < KEPT_WORDS:
                    self._found[word] = weight
            found[word] = weight
        return found


def context(text: str, start: int, end: int, before: list[str], after: list[str], others: int) -> float:
    """How much a term at text[start:end] counts: less inside quotation marks or next to reporting words, more where
    somebody is addressed or other terms stand near. `before` and `after` are the words of the window."""
    left, right = text[max(0, start - QUOTE_REACH) : start], text[end : end + QUOTE_REACH]
    quoted = any(
        closing in right and (left.count(opening) % 2 == 1 if opening == closing else left.rfind(opening) > left.rfind(closing))
        for opening, closing in QUOTES
    )
    near = {*before, *after}
    value = 1.0 - 0.5 * quoted - 0.2 * bool(near & REPORTING) + 0.2 * bool(near & ADDRESSING) + 0.1 * min(others, 3)
    return min(max(value, 0.2), 1.5)


def amount(text: str | None, matcher: Matcher) -> float:
    """The text's terms, each by its weight and context; 0 if it has none, is empty or null."""
    text = (text or "").lower()
    found = matcher.of(set(WORD.findall(text)))
    if not found:
        return 0.0
    spans = [(m.group(), m.start(), m.end()) for m in WORD.finditer(text)]
    places = [i for i, (word, _, _) in enumerate(spans) if word in found]
    total, first, last = 0.0, 0, 0
    for i in places:
        while places[first] < i - WINDOW:
            first += 1
        while last < len(places) and places[last] <= i + WINDOW:
            last += 1
        word, start, end = spans[i]
        before = [w for w, _, _ in spans[max(0, i - WINDOW) : i]]
        after = [w for w, _, _ in spans[i + 1 : i + 1 + WINDOW]]
        total += found[word] * context(text, start, end, before, after, last - first - 1)
    return total


@dataclass
class Model:
    matcher: Matcher
    slope: float
    bias: float

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * math.log1p(amount(text, self.matcher)) + self.bias))))


def training_rows(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """(text, toxic, calibrate) of a bounded sample of the labelled rows that `learn` allows (a condition on doc_id)."""
    wanted = labels.where(learn & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    wanted = wanted.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    parts = [
        wanted.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(rows)
        for label, rows in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))
    ]
    sample = parts[0].unionByName(parts[1]).select(
        F.col("doc_id").alias("sample_id"), "toxic", (F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(CALIBRATE)) == 0).alias("calibrate")
    )
    # At most TOXIC_ROWS + CLEAN_ROWS short rows.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("sample_id"))
    return rows.select("text", "toxic", "calibrate")


def _surprise(toxic: Column, clean: Column, base: float) -> Column:
    """Minus the log of a bound on the chance that a word so often in toxic rows has nothing to do with the label."""
    n = toxic + clean
    share = toxic / n
    rest = F.when(clean > 0, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    return F.when(share > base, n * (share * F.log(share / base) + rest)).otherwise(0.0)


def learn_model(docs: DataFrame, labels: DataFrame, scratch: Scratch, learn: Column | None = None) -> Model:
    """Terms, their weights, ordinary words that resemble them, and the calibration, from a bounded sample of labels.

    A word is a term if it stands in toxic rows more often than chance allows among all words tested. Toxic rows count by
    the different words before or after a word in them, whichever are fewer, so that copied passages make no terms. Ordinary words, those
    of clean rows, misspell nothing. The calibration uses rows that terms and ordinary words were not learned from.
    Without toxic or without clean rows there are no terms.
    """
    rows = scratch.save(training_rows(docs, labels, F.lit(True) if learn is None else learn), "training")
    learned = rows.where("not calibrate")
    sizes = {r["toxic"]: r["n"] for r in learned.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model(Matcher({}), 0.0, 30.0 if toxic else -30.0)
    base = toxic / (toxic + clean)
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD_JVM), F.lit(0)))
    is_toxic = F.col("toxic").cast("long")
    counts = learned.select("toxic", F.explode(words).alias("word")).groupBy("word")
    counts = scratch.save(counts.agg(F.sum(is_toxic).alias("toxic"), F.sum(1 - is_toxic).alias("clean")), "words")
    least = math.log(max(counts.count(), 1)) + 1
    surprise = _surprise(F.col("toxic"), F.col("clean"), base)
    candidates = counts.withColumn("surprise", surprise).where((F.col("toxic") >= 3) & (F.col("surprise") > least))
    # The sample bounds these: a significant word stands in three of its toxic rows at least.
    weights = _terms(learned, candidates, least, toxic, clean, base)
    matcher = Matcher(weights)
    ordinary = counts.where("clean > 0").select("word").mapInArrow(_resembling(matcher), "word string").collect()
    matcher = Matcher(weights, frozenset(r["word"] for r in ordinary) - weights.keys())
    return Model(matcher, *_calibrated(rows.where("calibrate"), matcher, base))


def _terms(learned: DataFrame, candidates: DataFrame, least: float, toxic: int, clean: int, base: float) -> dict[str, float]:
    """The candidates that hold when toxic rows count by neighbours, with their log odds, 1 for the clearest possible."""
    found = {r["word"]: (r["toxic"], r["clean"]) for r in candidates.collect()}

    def neighbours(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            pairs = []
            for text in part.column(0).to_pylist():
                words = WORD.findall((text or "").lower())
                first = {w: i for i, w in reversed(list(enumerate(words))) if w in found}
                pairs += [(w, words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else "") for w, i in first.items()]
            columns = list(zip(*pairs, strict=True)) or [(), (), ()]
            yield pa.record_batch([pa.array(c, pa.string()) for c in columns], ["word", "before", "after"])

    around = learned.where("toxic = 1").select("text").mapInArrow(neighbours, "word string, before string, after string")
    contexts = around.groupBy("word").agg(F.least(F.count_distinct("before"), F.count_distinct("after")).alias("n"))
    weights = {}
    most = math.log((toxic + 0.5) / (toxic + 1) / (0.5 / (clean + 1)))
    for word, different in contexts.collect():
        hits, misses = min(different, found[word][0]), found[word][1]
        n, share = hits + misses, hits / (hits + misses)
        rest = (1 - share) * math.log((1 - share) / (1 - base)) if misses else 0.0
        if share > base and n * (share * math.log(share / base) + rest) > least:
            odds = math.log((found[word][0] + 0.5) / (toxic + 1)) - math.log((misses + 0.5) / (clean + 1))
            weights[word] = round(max(odds, 0.05 * most) / most, 4)
    return weights


def _resembling(matcher: Matcher) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def close(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            words = [w for w in part.column(0).to_pylist() if w not in matcher.weights and matcher.misspells(w)]
            yield pa.record_batch([pa.array(words, pa.string())], ["word"])

    return close


def _amounts(matcher: Matcher) -> Callable[..., Column]:
    @F.pandas_udf("double")
    def of_texts(texts: pd.Series) -> pd.Series:
        return pd.Series([amount(t, matcher) for t in texts], dtype="float64")

    return of_texts


def _calibrated(rows: DataFrame, matcher: Matcher, base: float) -> tuple[float, float]:
    """Slope and bias of a logistic regression on the log of the amount, from counts by rounded amount."""
    step = F.round(F.least(F.log1p(_amounts(matcher)("text")), F.lit(6.0)), 2)
    table = rows.select(step.alias("x"), "toxic").groupBy("x", "toxic").agg(F.count("*").alias("n")).collect()
    x = np.array([r["x"] for r in table] + [0.0, math.log1p(3)])
    y = np.array([r["toxic"] for r in table] + [0, 1], dtype=float)
    # One clean row without terms and one toxic row with three stand for what is known beforehand.
    n = np.array([r["n"] for r in table] + [1, 1], dtype=float)
    features, w = np.stack([x, np.ones_like(x)], axis=1), np.array([2.0, math.log(base / (1 - base)) - 1])
    ridge = np.diag([1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        gradient = features.T @ (n * (y - p)) - ridge @ w
        hessian = features.T @ (features * (n * p * (1 - p))[:, None]) + ridge
        w = w + np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return float(w[0]), float(w[1])


def scorer(model: Model) -> Callable[..., Column]:
    """Scores of whole texts, 0 to 1."""

    @F.pandas_udf("double")
    def of_texts(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([model.score(t) for t in batch], dtype="float64")

    return of_texts


def fold(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % folds


def toxicity_scores(docs: DataFrame, labels: DataFrame, scratch: Scratch, learn: Column | None = None) -> DataFrame:
    """(doc_id, score), a row for each row of `docs`. Null and empty texts have the score of a text without terms. Repeated
    labels of an id count once, as toxic if any is; labels of unknown ids, null ids and other values are not used. Without labels all
    score near 0. Other columns are not read. No rows give none."""
    ship(docs.sparkSession)
    model = learn_model(docs, labels, scratch, learn)
    return docs.select("doc_id", scorer(model)("text").alias("score"))


def keep_clean(docs: DataFrame, labels: DataFrame, scratch: Scratch, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that score below the threshold, with all their columns; learned from every label's row."""
    ship(docs.sparkSession)
    model = learn_model(docs, labels, scratch)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("scored"))
    return rows.where(scorer(model)("scored") < threshold).select("row.*")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = toxicity_scores(documents(spark, sf_dir), labels, Scratch(spark, "toxicity"), fold(5) != 0)
    held_out = F.coalesce(fold(5) == 0, F.lit(False))
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

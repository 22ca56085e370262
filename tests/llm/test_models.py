"""Language mixtures and toxicity: held-out accuracy, and the parts against plain Python."""

import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from llm_cases import SF_DIR, no_docs, odd_docs, real_docs
from pyspark.sql import functions as F

from lodestone.llm import langid
from lodestone.llm.queries import QUERIES
from lodestone.llm.scratch import Scratch
from lodestone.llm.toxicity import ADDRESSING, REPORTING, Matcher, Model, amount, build_trie, close_terms, keep_clean, learn_model, toxicity_scores


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_and_trie_find_every_close_term():
    random.seed(1)
    words = ["".join(random.choice("abc") for _ in range(random.randrange(1, 9))) for _ in range(120)]
    trie = build_trie(words)
    for word in ["", "a", "abcabc", *words[:40]]:
        for most in (0, 1, 2):
            expected = sorted({(edits(word, t), t) for t in words if edits(word, t) <= most})
            assert [(n, t) for t, n in close_terms(word, trie, most)] == expected


def test_matcher_misses_no_misspelling_of_a_long_term():
    terms = {"worthless": 1.0, "moron": 1.0, "scum": 1.0}
    matcher = Matcher(terms, frozenset({"moroc"}))
    for term in ("worthless", "moron"):
        for i, letter in itertools.product(range(len(term) + 1), "xé"):
            for word in (term[:i] + letter + term[i:], term[:i] + letter + term[i + 1 :], term[:i] + term[i + 1 :]):
                assert matcher.of({word}), word
    assert matcher.of({"scam", "moroc", "mormons", ""}) == {}
    assert matcher.of({"moron", "scum"}) == {"moron": 1.0, "scum": 1.0}


def test_context_tells_quotation_from_abuse():
    matcher = Matcher({"moron": 1.0, "trash": 1.0})
    quoted = amount('The word "moron" is old, he said.', matcher)
    plain = amount("A moron lives there.", matcher)
    abuse = amount("You moron, you are trash", matcher) / 2
    assert 0 < quoted < plain < abuse
    assert amount(None, matcher) == amount("", matcher) == amount(" ", matcher) == 0


def test_toxicity_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = QUERIES["op3_toxicity"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000
    held = [r for r in rows if r.doc_id in labels and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    right = sum(labels[r.doc_id] == r.predicted for r in held)
    assert right / len(held) > 0.94
    assert not any(r.predicted and not labels[r.doc_id] for r in held)


def test_toxicity_of_odd_rows(spark, scratch):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (None, 1), (777, 1), (9, None), (10, 3)], "doc_id long, toxic int")
    rows = toxicity_scores(docs, labels, scratch).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score < 0.5 for r in toxicity_scores(docs, nothing, Scratch(spark, "a")).collect()} == {True}
    kept = keep_clean(docs, nothing, Scratch(spark, "b"))
    assert kept.schema == docs.schema and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    assert toxicity_scores(no_docs(spark), nothing, Scratch(spark, "c")).count() == 0


def test_copied_passages_make_no_terms(spark, scratch):
    """A word of a toxic passage that is copied often is no term; a word of many toxic texts is."""
    random.seed(2)
    word = lambda: "".join(random.choice("bcdfgaeiou") for _ in range(6))
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        words = [word() for _ in range(30)]
        if toxic:
            words[3] = "grumbold"
            words += "these same seven words end every text".split()
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    model = learn_model(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), scratch)
    assert set(model.matcher.weights) == {"grumbold"}
    assert model.score("so grumbold a thing, grumbold") > 0.5 > model.score("these same seven words end every text")
    assert isinstance(model, Model)


def test_language_on_held_out_rows(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = QUERIES["op2_language"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in rows if r.held_out and langs[r.doc_id]]
    assert len(rows) == 1000 and len(held) > 250
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) / len(held) > 0.97


def test_language_of_odd_rows(spark, scratch):
    rows = langid.languages(odd_docs(spark), scratch).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == 13
    for i in (1, 2, 3, 10):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].mixture) == ("und", 0.0, {})
    assert by_id[7].lang_pred == by_id[8].lang_pred == "fr" and by_id[11].lang_pred == "ja"
    assert langid.languages(no_docs(spark), Scratch(spark, "none")).count() == 0
    unlabelled = odd_docs(spark).where("lang is null")
    assert {r.lang_pred for r in langid.languages(unlabelled, Scratch(spark, "unlabelled")).collect()} == {"und"}


def test_mixture_finds_proportions_and_the_set_of_languages(spark, scratch):
    docs = real_docs(spark)
    model = langid.learn_model(docs, scratch)
    texts = {lang: " ".join(r.text for r in docs.where(f"lang = '{lang}'").limit(5).collect())[:4000] for lang in ("de", "fr")}
    shares = dict(zip(model.languages, model.mixture(texts["de"][:3000] + " " + texts["fr"][:1000]), strict=True))
    assert shares["de"] == pytest.approx(0.75, abs=0.08) and shares["fr"] == pytest.approx(0.25, abs=0.08)
    assert shares["en"] == shares["es"] == 0
    assert np.isclose(sum(shares.values()), 1)


def test_rounds_run_on_doubles_made_once_and_give_the_plain_formula(monkeypatch):
    """What the rounds multiply is in double precision, so that no round converts it; the proportions are those of the formula."""
    rng = np.random.default_rng(7)
    logs = np.log(rng.dirichlet(np.full(langid.BUCKETS, 0.05), 5).T + 1e-7).astype(np.float32)
    model, kinds, em = langid.Model(list("abcde"), logs), set(), langid._em

    def plain(likely, counts, total):
        share = np.full(len(likely), 1 / len(likely))
        for _ in range(langid.ROUNDS if len(share) > 1 else 0):
            after = np.array([share[i] * sum(c * row[i] / (row @ share) for c, row in zip(counts, likely.T, strict=True)) for i in range(len(share))]) / total
            after /= after.sum()
            moved, share = np.abs(after - share).max(), after
            if moved < 1e-4:
                break
        return share, sum(c * np.log(row @ share) for c, row in zip(counts, likely.T, strict=True))

    def spied(likely, counts, total):
        kinds.add((likely.dtype, likely.shape[0] <= 5, likely.shape[1] == len(counts)))
        found, expected = em(likely, counts, total), plain(likely, counts, total)
        assert np.allclose(found[0], expected[0], rtol=0, atol=1e-12) and np.isclose(found[1], expected[1], rtol=1e-12)
        return found

    monkeypatch.setattr(langid, "_em", spied)
    for text in ("one", "some words of a text", "été à la plage, wo die Sonne scheint", " ".join(f"w{i:x}rd" for i in range(400)).translate(str.maketrans("0123456789", "ghijklmnop"))):
        shares = model.mixture(text)
        assert np.isclose(shares.sum(), 1) and (shares >= 0).all()
    assert kinds == {(np.dtype(np.float64), True, True)}


def test_codes_see_letters_of_any_script_and_nothing_else():
    assert len(langid.codes("12 3 !? \n")) == 0 and len(langid.codes("")) == 0
    assert langid.codes("a1b").tolist() == langid.codes("A..B").tolist() == langid.codes("a b").tolist()
    assert len(langid.codes("日本")) and len(langid.codes("é")) and SF_DIR


def likelihood(model, text, shares):
    grams = langid.codes(text)
    return float(np.log(np.exp(model.logs[grams].astype(float)) @ shares).sum())


def test_mixture_is_the_best_of_a_grid_over_sets_and_proportions(spark, scratch):
    """The penalised likelihood of what is found, against every set of the four languages and proportions in steps of a twentieth."""
    docs = real_docs(spark)
    model = langid.learn_model(docs, scratch)
    rng = random.Random(4)
    rows = docs.where("lang is not null and text is not null").select("lang", "text").collect()
    size = len(model.languages)
    grid = [np.array(p) / 20 for p in itertools.product(range(21), repeat=size) if sum(p) == 20]
    shorter = 0
    for _ in range(25):
        one, other = rng.choice(rows).text, rng.choice(rows).text
        text = one[: rng.choice([30, 120, 400])] + " " + other[: rng.choice([0, 60, 200])]
        if not len(langid.codes(text)):
            continue
        penalty = 0.5 * np.log(len(langid.codes(text)) + 1)
        logs = np.exp(model.logs[langid.codes(text)].astype(float))
        best = max(float(np.log(logs @ p + 1e-300).sum()) - penalty * np.count_nonzero(p) for p in grid)
        found = model.mixture(text)
        value = likelihood(model, text, found) - penalty * np.count_nonzero(found)
        # Dropping one language after another may end beside the best set; never by as much as one language costs.
        assert value > best - 0.5 * penalty, text
        shorter += value < best - 0.05
        name, score = model.predict(text)
        assert name == model.languages[int(found.argmax())] and score == pytest.approx(found.max())
    assert shorter <= 2


def test_any_number_of_languages_is_learned(spark, scratch):
    """Beyond two hundred languages, each with letters of its own."""
    names = [f"l{i:03d}" for i in range(230)]
    word = {n: "".join(chr(97 + (i // 26**k) % 26) for k in range(2)) * 3 for i, n in enumerate(names)}
    rows = [(i, " ".join([word[n]] * 20), n) for i, n in enumerate(names)]
    found = langid.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), scratch).collect()
    assert [r.lang_pred for r in sorted(found, key=lambda r: r.doc_id)] == names


def plain_amount(text, weights, ordinary):
    """What a text's terms add up to, by comparing each word with each term."""
    text = text.lower()
    words = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text)]

    def weight(word):
        if word in weights or word in ordinary:
            return weights.get(word, 0)
        close = [w for t, w in weights.items() if len(t) >= 5 and edits(word, t) <= 1]
        return 0.5 * max(close) if close else 0

    worth = [weight(w) for w, _, _ in words]
    total = 0.0
    for i, (_, start, end) in enumerate(words):
        if not worth[i]:
            continue
        near = range(max(0, i - 12), min(len(words), i + 13))
        left, right = text[max(0, start - 60) : start], text[end : end + 60]
        quoted = any(
            b in right and (left.count(a) % 2 if a == b else left.rfind(a) > left.rfind(b)) for a, b in (('"', '"'), ("“", "”"), ("„", "“"), ("«", "»"), ("‘", "’"))
        )
        around = {words[j][0] for j in near if j != i}
        value = 1 - 0.5 * quoted - 0.2 * bool(around & REPORTING) + 0.2 * bool(around & ADDRESSING) + 0.1 * min(3, sum(worth[j] > 0 for j in near) - 1)
        total += worth[i] * min(max(value, 0.2), 1.5)
    return total


def test_whole_scores_against_comparing_every_word_with_every_term(spark, scratch):
    """Of documents with toxic labels and others, their words partly misspelt and quoted."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = learn_model(docs, labels, scratch)
    weights, ordinary = model.matcher.weights, model.matcher.ordinary
    assert weights
    rng = random.Random(6)
    texts = [r.text for r in docs.join(labels, "doc_id").orderBy(F.desc("toxic"), "doc_id").limit(12).collect()]
    terms = sorted(weights)
    for _ in range(25):
        words = rng.choices(["you", "said", "der", "x1", "Ding"], k=25)
        for _ in range(4):
            term = rng.choice(terms)
            at = rng.randrange(len(term))
            words.insert(rng.randrange(len(words)), rng.choice([term, term.upper(), term[:at] + term[at + 1 :], term[:at] + "q" + term[at:], f'"{term}"', f"«{term}»"]))
        texts.append(" ".join(words))
    for text in texts:
        found = plain_amount(text[:4000], weights, ordinary)
        assert amount(text[:4000], model.matcher) == pytest.approx(found, rel=1e-9)
        expected = 1 / (1 + math.exp(-max(-30, min(30, model.slope * math.log1p(found) + model.bias))))
        assert model.score(text[:4000]) == pytest.approx(expected, rel=1e-9)


def test_a_very_long_word_costs_no_time():
    matcher = Matcher({"worthless": 1.0, "scoundrel": 1.0})
    start = time.perf_counter()
    assert amount("wort" + "h" * 300_000 + " worthles", matcher) > 0
    assert time.perf_counter() - start < 0.5

"""Language identification and toxicity: held-out accuracy and odd texts."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from obslake.llm import language_id, toxicity
from obslake.llm.registry import registered
from tests.llm.conftest import SHAPE, fold

HELD = "/root/testdata/sf0.01"
VOCABULARY = {
    "en": "the quick brown fox jumps over lazy dogs with great speed and then sleeps through winter".split(),
    "de": "der schnelle braune fuchs springt über faule hunde und schläft dann tief durch winternächte".split(),
    "fr": "le renard brun rapide saute par-dessus les chiens paresseux et dort ensuite tout l'hiver".split(),
}


def prose(lang: str, n: int, rng: random.Random) -> str:
    return " ".join(rng.choice(VOCABULARY[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(3)
    rows = [(i, prose(lang, 60, rng), lang, "s", 1) for i, lang in enumerate(list(VOCABULARY) * 10)]
    rows += [(99, None, "en", "s", 1), (100, "no language", None, "s", 1)]
    return language_id.train(spark.createDataFrame(rows, SHAPE))


def test_held_out_languages(spark):
    df = registered()["op5_language_id"](spark, HELD)
    truth = spark.read.parquet(f"{HELD}/documents.parquet").select("doc_id", "lang", "text")
    rows = df.join(truth, "doc_id").collect()
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in rows)
    held = [r for r in rows if r["held_out"] and language_id.has_letter(r["text"])]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98
    assert all(r["lang_pred"] == "und" for r in rows if not language_id.has_letter(r["text"]))


def test_mixtures(spark, model):
    rng = random.Random(5)
    rows = [
        (1, prose("en", 300, rng)),
        (2, prose("de", 300, rng) + " " + prose("fr", 100, rng)),
        (3, prose("fr", 150, rng) + " " + prose("en", 150, rng) + " " + prose("de", 150, rng)),
    ]
    found = {r["doc_id"]: r for r in language_id.detect(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [p["lang"] for p in found[1]["languages"]] == ["en"] and found[1]["score"] == 1
    assert found[2]["lang_pred"] == "de"
    assert {p["lang"]: p["share"] for p in found[2]["languages"]} == pytest.approx({"de": 0.75, "fr": 0.25}, abs=0.05)
    assert len(found[3]["languages"]) == 3 and found[3]["score"] < 0.5


def test_odd_texts_have_a_language_or_none(spark, model, odd, empty):
    rows = language_id.detect(odd, model).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert all((by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0) for i in (2, 3, 4, 8))
    assert by_id[None]["lang_pred"] == "en" and by_id[5]["_own"] == 3
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert language_id.detect(empty, model).collect() == []
    nothing = language_id.train(empty)
    assert {r["lang_pred"] for r in language_id.detect(odd, nothing).collect()} == {"und"}


@pytest.mark.parametrize(("text", "words"), [("a", 1), ("hello", 1), ("Avec.", 1), ("hello big world", 3), (" 12 ", 0)])
def test_every_word_has_a_start(text, words):
    bucket, starts = language_id._trigrams(text)
    assert len(starts) == words and (starts < len(bucket)).all()


def test_one_word_texts_have_a_language(spark, model):
    rows = [(1, "sleeps", "en"), (2, "Schläft.", "de"), (3, "paresseux!", "fr"), (4, "winternächte", "de"), (5, "12.", "en")]
    docs = spark.createDataFrame([(i, t, l, "s", len(t)) for i, t, l in rows], SHAPE)
    found = {r["doc_id"]: r for r in language_id.detect(docs, model).collect()}
    assert all((found[i]["lang_pred"], found[i]["score"]) == (l, 1) for i, _, l in rows[:4])
    assert (found[5]["lang_pred"], found[5]["score"]) == ("und", 0)
    # The last word counts on its own, not as part of the one before.
    last = language_id.detect(spark.createDataFrame([(1, "schläft paresseux")], "doc_id long, text string"), model, penalty=0.0)
    assert {p["lang"]: p["share"] for p in last.first()["languages"]} == pytest.approx({"de": 0.5, "fr": 0.5}, abs=0.05)


def test_labels_are_no_input(spark, model):
    rows = [(1, prose("de", 50, random.Random(1)), "en", "x", 0)]
    got = language_id.detect(spark.createDataFrame(rows, SHAPE), model).first()
    assert got["lang_pred"] == "de" and got["lang"] == "en"


# --- toxicity ------------------------------------------------------------------------


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_edit_distance():
    rng = random.Random(2)
    entries = ["abcab", "bcacb", "ccc", "ab"]
    stems = ["cabb"]
    root = toxicity.build_trie(entries, stems)
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("abc", repeat=n)]
    for word in [*words, *("".join(rng.choice("abc") for _ in range(7)) for _ in range(300))]:
        whole = min(edits(word, e) for e in entries)
        started = min(edits(word[:k], s) for s in stems for k in range(len(word) + 1))
        found = toxicity.match(word, root, 0)
        nearest = min(whole, started)
        assert (found and found[1]) == (nearest if nearest <= 1 else None), word
        strict = toxicity.match(word, root, 99)
        assert (strict is not None) == (nearest == 0), word


def test_quotation_is_no_abuse():
    model = toxicity.ToxicityModel(("idiot",), (), (0.0,) * 5)
    matcher = toxicity._Matcher(model)
    assert toxicity._features("You are an idiot indeed", matcher, 6)[:2] == (float(np.log1p(1)), 0.0)
    assert toxicity._features('he was called an "idiot" by them', matcher, 6)[:2] == (0.0, float(np.log1p(1)))
    assert toxicity._features("“idiot”", matcher, 6)[1] == 0.0  # no words around it, no quotation window


def test_held_out_toxicity(spark):
    df = registered()["op10_toxicity"](spark, HELD)
    labels = spark.read.parquet(f"{HELD}/labels.parquet")
    rows = df.join(labels, "doc_id", "left").collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    clean = [r for r in rows if r["held_out"] and r["toxic"] == 0]
    bad = [r for r in rows if r["held_out"] and r["toxic"] == 1]
    assert np.mean([r["predicted"] for r in clean]) < 0.02
    assert np.mean([r["predicted"] for r in bad]) > 0.5


def test_what_hits_are_worth(spark):
    """Misspelled, with inner digits and quoted: each less than the term itself, none below clean."""
    rng = random.Random(11)
    terms = ["scum", "idiot", "worthless", "trash"]
    rows = [(i, f"{prose('en', 25, rng)} {rng.choice(terms)} {prose("en", 5, rng)}", 1) for i in range(300)]
    rows += [(1000 + i, prose("en", 30, rng) + " trace " + rng.choice(["smog", "idol", "scam"]), 0) for i in range(600)]
    rows += [(5000 + i, "copy of one text " + " ".join(f"odd{j}" for j in range(30)) + f" idiot {i % 3}", 1) for i in range(200)]
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert set(model.terms) == set(terms) and not model.stems  # no word of a text that is only often repeated
    exact, exact_quoted, fuzzy, fuzzy_quoted = model.weights[:4]
    assert exact >= fuzzy >= fuzzy_quoted >= 0 and exact > exact_quoted >= fuzzy_quoted
    texts = ["a lovely day", "you idiot", "you idot", "you 1d10t, id1ot", "the “idiot” again", "the scam", "you scun", "no!idiot", "trashed"]
    got = toxicity.score_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    score = {texts[r["doc_id"]]: r["score"] for r in got}
    clean = score["a lovely day"]
    assert score["the scam"] == clean  # clean rows have this word
    for toxic in ("you idiot", "you idot", "you 1d10t, id1ot", "you scun", "no!idiot"):
        assert score[toxic] > 0.5 > clean
    assert clean <= score["the “idiot” again"] < score["you idiot"] and score["you idot"] <= score["you idiot"]


def test_rare_terms_and_stems_before_the_limit(spark):
    """150 terms, each in under 1 % of the toxic rows; their stems do not use up the entries."""
    rng = random.Random(6)
    terms = ["".join(rng.choice("bcdfgjklmnpqvwxz") for _ in range(9)) for _ in range(150)]
    rows = [(i, f"{prose('en', 10, rng)} {terms[i % 150]}", 1) for i in range(1800)]
    rows += [(5000 + i, prose("en", 10, rng), 0) for i in range(1800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df, entries=150)
    assert set(model.terms) == set(terms) and not model.stems


def test_misspelled_terms_and_odd_tables(spark, odd, empty):
    rng = random.Random(4)
    rows = [(i, prose("en", 30, rng) + (" worthless scoundrels" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(90)]
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert {"worthless", "scoundrels"} <= {*model.terms, *model.stems}
    tests = spark.createDataFrame([(1, "utterly worthles scoundrel"), (2, "a WORTHLESS day"), (3, "the quick fox")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in toxicity.score_documents(tests, model).collect()}
    assert found[2]["predicted"] == 1 and found[3]["predicted"] == 0
    assert found[1]["predicted"] == 1 and found[1]["score"] > 10 * found[3]["score"]
    odd_rows = toxicity.score_documents(odd, model).collect()
    assert len(odd_rows) == odd.count() and all(r["predicted"] == 0 for r in odd_rows)
    assert toxicity.score_documents(empty, model).collect() == []
    for label in (0, 1, None):
        one = spark.createDataFrame([(1, "x", label)], "doc_id long, text string, toxic int")
        score = toxicity.score_documents(tests, toxicity.train(one)).select(F.max("score")).first()[0]
        assert (score >= 0.5) == (label == 1)

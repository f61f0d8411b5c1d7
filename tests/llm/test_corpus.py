"""Language model, repeated strings, near duplicates: against brute force."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from obslake.llm import blocks as B
from obslake.llm import near_duplicates, ngram_lm, repeated_strings
from obslake.llm.components import components
from obslake.llm.registry import registered
from tests.conftest import SMALL
from tests.llm.conftest import fold


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


# --- blocks --------------------------------------------------------------------------


def test_word_hashes():
    texts = [b"A b\tc  d", b"", b" \n ", "É x".encode(), b"one", b"the the The", b"\x1cx"]
    hashed, counts = B.word_hashes(texts)
    assert counts.tolist() == [4, 0, 0, 2, 1, 3, 1]
    again, same = B.word_hashes(texts, piece=3)
    assert (hashed == again).all() and (counts == same).all()
    names = [w for t in texts for w in t.lower().split()]
    assert len(set(zip(names, hashed.tolist()))) == len(set(names)) == len(set(hashed.tolist()))


def test_packed_arrays():
    arrays = [np.arange(5), np.zeros(0, np.uint8), np.array([2**64 - 1], np.uint64), np.array([-1, 3], np.int32)]
    for a, b in zip(arrays, B.unpacked(B.packed(arrays))):
        assert a.dtype == b.dtype and (a == b).all()


def test_owner_tree():
    assert B.owner_tree(0) == (1, 1) and B.owner_tree(43) == (43, 1) and B.owner_tree(64, 64) == (64, 1)
    assert B.owner_tree(65, 64) == (9, 2) and B.owner_tree(5000, 64) == (18, 3) and B.owner_tree(1, 2) == (1, 1)
    for n in (1, 63, 65, 4096, 4097, 10**6):
        tree = B.owner_tree(n)
        assert n <= tree.owners and tree.fan <= B.FAN


def asked_of(spark, n_blocks: int, tree: B.Tree, bits: int):
    """A question of every block, and the keys of each."""
    keys = {b: np.unique(np.random.default_rng(b).integers(0, 1 << bits, 300, dtype=np.uint64)) for b in range(n_blocks)}
    keys = {b: np.unique(np.append(k, [np.uint64(5), np.uint64((1 << bits) - 1)])) for b, k in keys.items()}
    rows = [(o, b, d) for b, k in keys.items() for o, d in B.questions(k, [np.full(len(k), b + 1)], tree.fan, bits)]
    return spark.createDataFrame(rows, "_owner int, _block int, _data binary"), keys


@pytest.mark.parametrize("fan", [2, 3, 64])
def test_answers_come_back_through_the_tree(spark, fan):
    tree = B.owner_tree(11, fan)
    asked, keys = asked_of(spark, 23, tree, 20)
    wanted = Counter()
    for b, k in keys.items():
        wanted.update(dict.fromkeys(k.tolist(), b + 1))
    got = B.answered(asked, tree, 20, summary=lambda k, sums: (len(k), int(sums.sum()))).toArrow()
    whole = got.filter(got.column("_data").is_null()).column("_summary").to_pylist()
    assert [sum(x) for x in zip(*whole)] == [len(wanted), sum(wanted.values())]
    mine = got.filter(got.column("_data").is_valid())
    for b, k in keys.items():
        answers = mine.filter([x == b for x in mine.column("_block").to_pylist()])
        assert B.totals_in_order(answers, 1)[:, 0].tolist() == [wanted[x] for x in k.tolist()]


def test_messages_grow_with_the_blocks(spark, monkeypatch):
    counts = {}
    inner = B.stored
    for n_blocks in (16, 128):
        sent = []
        monkeypatch.setattr(B, "stored", lambda df, label: sent.append(df := inner(df, label)) or df)
        tree = B.owner_tree(n_blocks // 2, 2)
        asked, _ = asked_of(spark, n_blocks, tree, 40)
        B.answered(asked, tree, 40).collect()
        # every level sends at most ``fan`` messages a block, there and back
        assert len(sent) == 2 * (tree.depth - 1)
        levels = [df.count() for df in sent]
        assert max(levels) <= 2 * n_blocks
        counts[n_blocks] = sum(levels) / (tree.depth - 1)
    assert counts[128] <= 1.1 * 8 * counts[16]


@pytest.mark.parametrize("fan", [2, 3])
def test_operators_with_a_deep_tree(spark, texts, monkeypatch, fan):
    monkeypatch.setattr(B, "BLOCK_BYTES", 12_000)
    df = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    assert B.owner_tree(B.block_count(B.text_bytes(df, "text")) // 4, fan).depth > 1
    groups = near_duplicates.near_duplicate_groups(df, fan=fan).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in groups} == grouped(texts)
    spans = repeated_strings.repeated_spans(df, length=60, fan=fan).collect()
    assert {r["doc_id"]: (r["n_bytes"], [tuple(s) for s in r["spans"]], r["kept_sha256"]) for r in spans} == removed(sorted(texts.items()), 60)
    roles = F.col("doc_id") % 7 != 2, F.col("doc_id") % 5 == 1
    deep, flat = (ngram_lm.score_texts(df, *roles, fan=n).orderBy("doc_id").collect() for n in (fan, 64))
    assert [tuple(r) for r in deep] == [tuple(r) for r in flat]


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60, 90)] + [(rng.randint(100, 130), rng.randint(100, 130)) for _ in range(20)]
    links += [(7, 200), (7, 201), (300, 7)]
    root = {n: n for pair in links for n in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["_node"]: r["_component"] for r in components(spark.createDataFrame(links, "_a long, _b long")).collect()}
    assert got == {n: r for n, r in root.items() if any(n in p and p[0] != p[1] for p in links)}


# --- language model ------------------------------------------------------------------


def test_language_model(spark, texts):
    rows = {r["doc_id"]: r for r in registered()["op3_language_model"](spark, SMALL).collect()}
    tokens = {i: [*words(t), None] for i, t in texts.items()}
    counts = Counter(w for i, t in tokens.items() if fold(i, 7) != 2 for w in t)
    total, distinct = sum(counts.values()), len(counts)
    assert rows.keys() == tokens.keys()
    for i, t in tokens.items():
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (fold(i, 7) == 2, len(t), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in t)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in t)
        assert r["base_score"] == pytest.approx(base)
        assert r["score"] < 0
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_probabilities_add_up(spark):
    """Scores are products of p(word | word before); in every context these sum to 1."""
    train = ["a b a c", "a b", "b a c c", "c"] * 6
    words_in = ["a", "b", "c", "new", None]
    known = Counter(w for t in train for w in [*t.split(), None])
    before = Counter(c for t in train for c in ["<", *t.split()])
    pairs = Counter(p for t in train for p in zip(["<", *t.split()], [*t.split(), None]))
    total, size = sum(known.values()), len(known)
    tests = ["a", "b c", "new", "c new a", ""]
    rows = [(i, t, True) for i, t in enumerate(train)] + [(100 + i, t, False) for i, t in enumerate(tests)]
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    tables = []
    inner = ngram_lm.mixture_weights

    def seen(*args, **kwargs):
        tables.append(inner(*args, **kwargs))
        return tables[-1]

    ngram_lm.mixture_weights = seen
    try:
        got = {r["doc_id"]: r["score"] for r in ngram_lm.score_texts(df, F.col("train"), F.col("doc_id") % 3 == 0).collect()}
    finally:
        ngram_lm.mixture_weights = inner
    (table,) = tables

    def p(word, context) -> float:
        weights = table[ngram_lm._bucket(np.array([before[context]]))[0]]
        parts = (1 / (size + 1), known[word] / total, pairs[context, word] / max(1, before[context]))
        return float(weights @ parts)

    for context in ("<", "a", "b", "c", "new"):
        assert sum(p(w, context) for w in words_in) == pytest.approx(1)
    for i, text in enumerate(tests):
        wanted = sum(math.log10(p(w, c)) for c, w in zip(["<", *text.split()], [*text.split(), None]))
        assert got[100 + i] == pytest.approx(wanted)


def test_expectation_maximisation_finds_the_weights():
    rng = np.random.default_rng(0)
    n = 200_000
    pair, word, uniform = rng.choice([0.6, 0.05], n), rng.choice([0.2, 0.02], n), 0.001
    true = 0.5 * pair + 0.3 * word + 0.2 * uniform
    weights = ngram_lm.mixture_weights(np.full(n, 3), pair, word, uniform, true * 1e5)
    likelihood = lambda w: (true * np.log(w[0] * uniform + w[1] * word + w[2] * pair)).sum()
    assert likelihood(weights[3]) >= max(likelihood(w) for w in ([0.2, 0.3, 0.5], [1 / 3] * 3, [0.1, 0.1, 0.8])) - 1e-9


def test_language_model_of_odd_tables(spark, odd, empty):
    rows = ngram_lm.score_texts(odd, F.col("doc_id") != 7, F.col("doc_id") == 5).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert [by_id[i]["n_tokens"] for i in (2, 3, 4)] == [1, 1, 1]
    assert by_id[7]["n_known"] == 1 and by_id[None]["n_tokens"] == 6  # only the end is known
    assert ngram_lm.score_texts(empty, F.lit(True), F.lit(False)).collect() == []
    untrained = ngram_lm.score_texts(odd, F.lit(False), F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["score"] == pytest.approx(0) for r in untrained)


# --- repeated strings ----------------------------------------------------------------


def removed(texts: list[tuple[int, str | None]], length: int) -> dict:
    bodies = {i: (t or "").encode() for i, t in texts}
    counts = Counter(b[p : p + length] for b in bodies.values() for p in range(len(b) - length + 1))
    found = {}
    for i, b in bodies.items():
        gone, spans, at = set(), [], 0
        for p in range(len(b) - length + 1):
            if counts[b[p : p + length]] > 1:
                gone.update(range(max(p, at), p + length))
                spans = [*spans[:-1], (spans[-1][0], p + length)] if spans and p <= spans[-1][1] else [*spans, (p, p + length)]
                at = p + length
        kept = bytes(x for p, x in enumerate(b) if p not in gone)
        found[i] = (len(b), spans, hashlib.sha256(kept).hexdigest())
    return found


def test_repeated_strings(spark, texts):
    rows = registered()["op2_repeated_strings"](spark, SMALL).collect()
    wanted = removed(sorted(texts.items()), 400)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert got == {i: (n, sum(b - a for a, b in s), len(s), h) for i, (n, s, h) in wanted.items()}
    assert any(r["n_removed"] for r in rows)


@pytest.mark.parametrize("length", [7, 20, 33])
def test_repeated_strings_that_overlap(spark, length):
    rng = random.Random(length)
    parts = ["".join(rng.choice("ab é") for _ in range(rng.randint(0, 60))) for _ in range(30)]
    docs = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))) for k in range(50)]
    docs += [(100, "a" * 200), (101, "ab" * 90), (102, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    spans = repeated_strings.repeated_spans(df, length=length)
    wanted = removed(docs, length)
    rows = spans.collect()
    assert {r["doc_id"]: (r["n_bytes"], [tuple(s) for s in r["spans"]], r["kept_sha256"]) for r in rows} == wanted
    for r in repeated_strings.cut(df, spans).collect():
        assert hashlib.sha256(bytes(r["kept_bytes"])).hexdigest() == wanted[r["doc_id"]][2]


def test_repeated_strings_of_odd_tables(spark, odd, empty):
    rows = repeated_strings.repeated_spans(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    # the long texts repeat themselves and each other; only the new word stays
    assert [tuple(s) for s in by_id[5]["spans"]] == [(0, by_id[5]["n_bytes"])]
    assert [tuple(s) for s in by_id[6]["spans"]] == [(0, by_id[6]["n_bytes"] - 3)]
    assert by_id[2]["n_bytes"] == 0 and not by_id[2]["spans"]
    assert repeated_strings.repeated_spans(empty).collect() == []
    three = spark.createDataFrame([(1, "x" * 400), (1, "x" * 400), (2, "y" * 399)], "doc_id long, text string")
    assert sorted(len(r["spans"]) for r in repeated_strings.repeated_spans(three).collect()) == [0, 1, 1]


# --- near duplicates -----------------------------------------------------------------


def grouped(texts: dict, percent: int = 80) -> dict:
    sets = {}
    for i, text in texts.items():
        w = words(text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    holders = defaultdict(list)
    for i, s in sets.items():
        for shingle in s:
            holders[shingle].append(i)
    common = Counter((a, b) for ids in holders.values() for a in ids for b in ids if a < b)
    root = {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((top(a), top(b)))
            root[b] = a
    return {i: (len(sets[i]), top(i)) for i in texts}


def test_near_duplicates(spark, texts):
    rows = registered()["op4_near_duplicates"](spark, SMALL).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == grouped(texts)


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_chains_hubs_and_common_passages(spark, percent):
    rng = random.Random(percent)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    docs, n = {}, 0
    for _ in range(6):
        text = [rng.choice(vocabulary) for _ in range(60)]
        for k in range(14):
            copy = list(text)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if k % 3 == 0:
                text = copy  # a chain as well as a hub
            docs[n], n = " ".join(copy + (passage if k % 4 == 0 else [])), n + 1
    docs |= {500: "a b", 501: "A  b", 502: "a b c", 503: "", 504: None, 505: "a b c d e", 506: "a b c d e f"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = near_duplicates.near_duplicate_groups(df, percent=percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == grouped(docs, percent)


def test_a_crowd_of_near_copies(spark):
    """Copies at the edge of the bound: linked by some, not by the most central one."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    docs = {}
    for i in range(160):
        copy = list(base)
        for k in range(rng.randint(1, 6)):
            copy[rng.randrange(150)] = f"x{rng.randrange(9) if k % 2 else i}"
        docs[i] = " ".join(copy)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = near_duplicates.near_duplicate_groups(df).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == grouped(docs)


def test_the_common_end_of_a_prefix_brings_no_pair_together(spark):
    """Of the shingles a candidate pair shares, one at least is left; its first one always is."""
    rng, meetings = random.Random(5), []
    for pair in range(300):
        sides = [sorted(rng.sample(range(40), rng.randint(8, 30))) for _ in range(2)]
        asked = [rng.randint(1, 8) for _ in range(2)]
        for token in sorted({*sides[0]} & {*sides[1]}):
            meetings.append((pair, token, *((len(t) - t.index(token), a) for t, a in zip(sides, asked))))
    side = "struct<_left:int,_l:int>"
    df = spark.createDataFrame(meetings, f"pair int, token int, x {side}, y {side}")
    met = {(r["pair"], r["token"]) for r in df.where(near_duplicates.has_room("x", "y")).select("pair", "token").collect()}
    shared = defaultdict(list)
    for pair, token, x, y in meetings:
        shared[pair, min(x[1], y[1])].append(token)
    assert all((pair, tokens[0]) in met for (pair, asked), tokens in shared.items() if len(tokens) >= asked)
    assert len(met) < 0.9 * len(meetings)


def test_near_duplicates_of_odd_tables(spark, odd, empty):
    rows = near_duplicates.near_duplicate_groups(odd).collect()
    assert len(rows) == odd.where("doc_id IS NOT NULL").count()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert found[2] == (0, 2) and found[3] == (0, 3) and found[4] == (0, 4)
    assert found[6][1] == 5 and found[1] == (2, 1)
    assert near_duplicates.near_duplicate_groups(empty).collect() == []


def test_prefix_choice_follows_the_cost():
    assert near_duplicates.prefix_choice(np.ones(10, np.int64), 80) == 1
    frequent = np.concatenate([np.ones(16, np.int64), np.full(64, 1000)])
    assert near_duplicates.prefix_choice(frequent, 80) >= 1
    assert near_duplicates.prefix_choice(np.full(80, 1000), 80) > 1

"""Line dedup, source mixing and quality rules."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from obslake.llm import line_dedup, mixing, quality_rules
from obslake.llm.registry import oracles, registered
from tests.conftest import SMALL
from tools.compare import differences, duckdb_over


@pytest.mark.parametrize("name", sorted(oracles()))
def test_against_sql(spark, name):
    df = registered()[name](spark, SMALL)
    rows = df.collect()
    assert rows
    assert differences(df, rows, duckdb_over(SMALL).sql(oracles()[name])) == []


@pytest.mark.parametrize("name", ["op6_line_dedup", "op7_mix_sources", "op8_quality_rules"])
def test_built_in_functions_only(spark, name):
    plan = registered()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# --- lines ---------------------------------------------------------------------------


def test_shared_lines_stay_in_the_largest_document(spark):
    shared = "This line is shared by all"
    rows = [
        (1, f"{shared}\nown one\n{shared}"),
        (2, f"\t{shared.upper()} \r\nown two\n"),
        (3, f"own three\n{shared}\n{shared}"),
        (4, "short\nshort"),
        (5, "short"),
        (6, "short"),
    ]
    got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()}
    assert found[1] == ("own one", 3, 2)
    assert found[2] == ("own two\n", 3, 1)
    assert found[3] == (rows[2][1], 3, 0)
    assert found[4] == ("short\nshort", 2, 0)


def test_lines_of_odd_tables(spark, odd, empty):
    got = line_dedup.drop_repeated_lines(odd)
    assert got.columns == [c for c in odd.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    rows = got.collect()
    assert len(rows) == odd.count()
    assert all(r["_text"] == "x" and r["_own"] == 3 for r in rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert (by_id[2]["text"], by_id[2]["n_lines"]) == ("", 1)
    assert by_id[4]["text"] == "\n \t\n" and by_id[4]["n_lines"] == 3
    assert line_dedup.drop_repeated_lines(empty).collect() == []


def test_repeated_rows_are_one_document(spark):
    line = "a line that is long enough"
    rows = [(1, line), (1, line), (2, line), (None, line)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in line_dedup.drop_repeated_lines(df, min_docs=3).collect()]
    assert sorted(got, key=str) == sorted([(1, "", 1, 1), (1, "", 1, 1), (2, line, 1, 0), (None, "", 1, 1)], key=str)
    assert all(r["n_dropped"] == 0 for r in line_dedup.drop_repeated_lines(df, min_docs=4).collect())


# --- mixing --------------------------------------------------------------------------


def filled(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    """Targets by pouring what is above a limit back, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > most * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: most * sizes[s] for s in over}


def test_mix_reaches_its_targets(spark):
    words = {"a": 30, "b": 900, "c": 4000, None: 2500, "é": 700, "z": 10}
    rows, n = [], 0
    for source, count in words.items():
        for i in range(10):
            rows.append((n, " ".join("w" * (count // 10)), source))
            n += 1
    rows.append((n, None, "a"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(df, block_words=8, shard_words=500)
    found = got.collect()
    targets = filled(words)
    taken: Counter = Counter()
    for r in found:
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert r["source_size"] == words[r["source"]]
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in targets.items():
        assert taken[source] == pytest.approx(target, abs=8 * 10 + 0.02 * target)
    again = mixing.mix_sources(df.repartition(7), block_words=8, shard_words=500).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in found)


def test_documents_are_drawn_whole(spark):
    rows = [(i, " ".join(["w"] * (150 + 7 * i)), "abc"[i % 3]) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix_sources(df).collect()
    parted = Counter(r["source"] for r in found if r["taken"] % r["size"])
    assert max(parted.values(), default=0) <= 1  # one shard a source
    times = {s: Counter(r["taken"] // r["size"] for r in found if r["source"] == s) for s in "abc"}
    assert times["a"][0] >= 10 and times["a"][1] >= 10  # weight 1 of 6: about half the words
    other = mixing.mix_sources(df, seed=8).collect()
    drawn = [{r["doc_id"] for r in got if r["taken"]} for got in (found, other)]
    assert drawn[0] != drawn[1]
    assert sum(r["taken"] for r in found) == pytest.approx(sum(r["size"] for r in found), abs=64 * 3)


def test_small_sources_reach_their_targets(spark):
    words = {"a": 40, "b": 30, "c": 9000, "d": 21, "e": 60, "f": 130}
    rows = [(i, " ".join(["w"] * (n // 2 + odd)), s) for i, (s, n, odd) in enumerate(
        (s, n, odd * (n % 2)) for s, n in words.items() for odd in (0, 1)
    )]
    found = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 2, 3000)).collect()
    targets = filled(words, (1, 2, 3000))
    assert min(targets.values()) < 32
    for source, target in targets.items():
        assert sum(r["taken"] for r in found if r["source"] == source) == pytest.approx(target, abs=1.01)


def test_a_small_source_leaves_the_blocks_of_others(spark):
    rows = [(i, " ".join(["w"] * 100), "big" if i % 2 else "other") for i in range(400)] + [(900, "a few words here", "tiny")]
    found = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), block_words=8).collect()
    targets = filled({"big": 20_000, "other": 20_000, "tiny": 4})
    taken = {s: sum(r["taken"] for r in found if r["source"] == s) for s in targets}
    assert taken["tiny"] == round(targets["tiny"]) == 12
    for source in ("big", "other"):
        assert taken[source] % 8 == 0 and taken[source] == pytest.approx(targets[source], abs=8)


def test_seats_are_those_of_the_highest_quotients(spark):
    targets = [53.0, 24.0, 24.0, 3.0, 0.5, 71.3]
    cells = spark.createDataFrame([(i, t, 12) for i, t in enumerate(targets)], "c long, t double, m long")
    for seats in (1, 4, 17, 40):
        won: Counter = Counter()
        for _ in range(seats):
            open_cells = [i for i in range(len(targets)) if won[i] < 12]
            if open_cells:
                won[min(open_cells, key=lambda i: (-targets[i] / (2 * won[i] + 1), i))] += 1
        got = {r["c"]: r["_seats"] for r in mixing.apportion(cells, "t", "m", seats, ["c"]).collect()}
        assert got == {i: won[i] for i in range(len(targets))}, seats


def test_mix_of_odd_tables(spark, odd, empty):
    rows = mixing.mix_sources(odd).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert all(r["taken"] == 0 for r in rows if r["doc_id"] in (2, 3, 4))
    assert mixing.mix_sources(empty).collect() == []
    assert {r["taken"] for r in mixing.mix_sources(odd.where("doc_id IN (2, 3)")).collect()} == {0}


# --- quality -------------------------------------------------------------------------


def test_odd_texts_are_measured(spark, odd, empty):
    rows = quality_rules.measured(odd).collect()
    assert len(rows) == odd.count() and rows[0]["_own"] == 3
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[2][m] == 0 for m in quality_rules.MEASURES)
    assert by_id[5]["n_words"] == 60_000 and by_id[5]["n_repeat_words"] == 60_000
    assert by_id[7]["n_words"] == 5  # white space beyond ASCII parts no words
    assert quality_rules.measured(empty).collect() == []


def test_policies_and_ablations(spark):
    rows = [("a b c",), ("x " * 40,), ("# one two three four five six seven eight nine ten eleven",),
            (" ".join(f"word{i}" for i in range(30)),)]
    kept = quality_rules.ledger(spark.createDataFrame(rows, "text string"))
    verdicts = {v: [r["kept"] for r in quality_rules.apply_policy(kept, v).collect()] for v in ("base", "v1", "v2")}
    assert verdicts["base"] == [False, False, True, True]
    assert verdicts["v2"] == [False, False, True, True]
    table = {r["rule"]: (r["n_failed"], r["n_rescued"]) for r in quality_rules.ablations(kept, "v2").collect()}
    assert table["few_words"] == (1, 0)  # its words are short as well
    assert table["repeated_words"][0] == 1
    assert quality_rules.ablations(kept.limit(0), "v2").collect() == []


def test_digest_of_a_document(spark, texts):
    got = {r["doc_id"]: r for r in registered()["op6_line_dedup"](spark, SMALL).collect()}
    for doc_id, text in texts.items():
        if got[doc_id]["n_dropped"] == 0:
            assert got[doc_id]["kept_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()

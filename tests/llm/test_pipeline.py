"""The pipeline: each stage's decisions, and the whole run against a plain version of them."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
from obslake.llm import language_id
from obslake.session import stored
from tests.conftest import SMALL
from tests.llm.conftest import SHAPE
from tests.llm.test_corpus import grouped, words
from tests.llm.test_native import filled


def key(line: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))


def without_shared_lines(texts: dict) -> dict:
    holders = defaultdict(set)
    for i, text in texts.items():
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(i)
    gone = {k: max(ids) for k, ids in holders.items() if len(ids) >= 3}
    return {
        i: "\n".join(x for x in (t or "").split("\n") if gone.get(key(x), i) == i) for i, t in texts.items()
    }


def test_stages(spark, texts):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), "stage")
        kept[name] = docs.collect()
        if name != "best-fit packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    spoken = {r["doc_id"]: r["text"] for r in kept["language ID"]}
    assert all(spoken[i] == texts[i] for i in spoken)
    assert {i for i in texts if i not in spoken} >= {i for i, t in texts.items() if not language_id.has_letter(t)}
    assert len(spoken) > 0.97 * len(texts)

    lines = {r["doc_id"]: r["text"] for r in kept["line dedup"]}
    assert lines == without_shared_lines(spoken)
    assert all(r["n_chars"] == len(r["text"]) for r in kept["line dedup"])

    single = {r["doc_id"]: r["text"] for r in kept["near duplicates"]}
    assert single == {i: lines[i] for i, (_, group) in grouped(lines).items() if group == i}

    sources = {r["doc_id"]: r["source"] for r in kept["near duplicates"]}
    sizes: Counter = Counter()
    for i, text in single.items():
        sizes[sources[i]] += len(words(text))
    taken, copies = Counter(), defaultdict(list)
    for r in kept["mixing sources"]:
        assert single[r["doc_id"]] == r["text"] and words(r["text"])
        taken[r["source"]] += len(words(r["text"]))
        copies[r["doc_id"]].append(r["text"])
    for i, found in copies.items():
        assert len(found) <= 3
    # A shard ends within half a document of its quota.
    longest = max(len(words(t)) for t in single.values())
    for source, target in filled(dict(sizes)).items():
        assert abs(taken[source] - target) <= longest / 2 + 64

    pieces = defaultdict(list)
    for r in kept["best-fit packing"]:
        pieces[r["doc_id"]].append(r)
    once = {i: t[0] for i, t in copies.items() if len(t) == 1}
    n = len({r["sequence_id"] for r in kept["best-fit packing"]})
    assert n <= -(-sum(r["length"] for r in kept["best-fit packing"]) // 2048) + 1
    assert pieces.keys() == copies.keys()
    for i in once:
        assert sum(r["piece"] == 0 for r in pieces[i]) == 1


def test_one_word_texts_pass_the_language_stage(spark):
    rows = [(i, text, "en", "s", len(text)) for i, text in enumerate(["hello", "Hello.", "hello world", "12", "..."])]
    kept = corpus_pipeline.known_language(spark, spark.createDataFrame(rows, SHAPE), SMALL)
    assert sorted(r["text"] for r in kept.collect()) == ["Hello.", "hello", "hello world"]


def test_the_mix_takes_documents_whole(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(400)) + f" end{i}", "en", "abc"[i % 3], 0) for i in range(60)]
    mix = corpus_pipeline.mixed(spark, spark.createDataFrame(rows, SHAPE), SMALL).collect()
    assert all(r["text"] == rows[r["doc_id"]][1] for r in mix)
    times = Counter(r["source"] for r in mix)
    assert [times[s] for s in "abc"] == [10, 20, 30]


def test_run_is_its_stages(spark, texts):
    first = corpus_pipeline.run(spark, SMALL).collect()
    again = corpus_pipeline.run(spark, SMALL).collect()
    plain = lambda rows: sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in rows)
    assert plain(first) == plain(again) and first


def test_odd_tables(spark, odd, empty):
    for docs in (odd.select(*corpus_pipeline.COLUMNS), empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SMALL), "stage")
        rows = docs.collect()
        assert {r["doc_id"] for r in rows} <= {1, 5, 6, 7}

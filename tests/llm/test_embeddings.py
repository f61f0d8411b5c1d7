"""Approximate neighbours and whitening against numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from obslake.llm import polytope, registered, whitening
from tests.conftest import SMALL

ODD = [(901, None), (902, [1.0, None]), (903, [float("nan")] * 6), (904, [float("inf")] * 6), (905, []), (None, [1.0] * 6)]
SHAPE = "vec_id long, embedding array<double>, label string, _v string, _id int, score int, n int, index int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "l", "v", 1, 2, 3, 4) for r in rows], SHAPE)


def brute(rows, asked, k=5):
    """Per query id and vector the best ids with their cosines, and the cosine of every id."""
    width = max(len(v) for _, v in rows)
    matrix = np.array([list(v) + [0.0] * (width - len(v)) for _, v in rows])
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    ids = np.array([i for i, _ in rows])
    found = {}
    for at in np.flatnonzero(asked(ids)):
        scores = unit @ unit[at]
        best = {}
        for i, s in zip(ids, scores):
            if i != ids[at]:
                best[int(i)] = max(s, best.get(int(i), -2))
        found[int(ids[at])] = sorted(best.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k], best
    return found


def recall(got, want, k=5):
    found = 0
    for query, (best, every) in want.items():
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == query)
        assert [rank for rank, _, _ in mine] == list(range(1, len(best) + 1))
        assert all(abs(score - every[i]) < 1e-12 for _, i, score in mine)
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        found += len({i for _, i, _ in mine} & {i for i, _ in best})
    return found / sum(len(best) for best, _ in want.values())


def test_hadamard_is_the_matrix():
    matrix = np.array([[1.0]])
    while len(matrix) < 16:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    x = np.random.default_rng(3).standard_normal((5, 16))
    assert np.allclose(polytope.hadamard(x), x @ matrix / 4)


@pytest.mark.parametrize("each", [1, 2, 3])
def test_probes_come_in_falling_likelihood(each):
    hashes = polytope.Hashes(5, 2, each, 1)
    unit = np.random.default_rng(4).standard_normal(5)
    unit /= np.linalg.norm(unit)
    every = hashes.probes(unit, 1, 0, hashes.buckets)
    assert sorted(every) == list(range(hashes.buckets)) and every[0] == hashes.own(unit[None], 1)[0]
    assert list(hashes.probes(unit, 1, 3, 9)) == list(every[3:9])
    needed = hashes.needed(0.9)
    assert needed[-1] == 1 and (np.diff(needed) <= 2).all() and needed[0] > needed[-1]


def test_recall_on_the_table(spark):
    rows = [(r["vec_id"], list(map(float, r["embedding"]))) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = registered()["op12_nearest"](spark, SMALL).collect()
    assert recall(got, brute(rows, lambda ids: ids % 50 == 0)) >= 0.95


@pytest.mark.parametrize("bucket_rows", [8, 1024])
def test_clusters_copies_and_odd_rows(spark, bucket_rows):
    rng = np.random.default_rng(bucket_rows)
    centres = rng.standard_normal((12, 6))
    rows = [(i, (centres[i % 12] + 0.1 * rng.standard_normal(6)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[5][1]) for i in range(200)]  # a third are copies
    rows += [(2000, [1.0, 2.0]), (2001, [1e300] * 6), (2002, [1e-300] * 6), (2010, rows[7][1])]
    df = frame(spark, rows + [rows[3]] + ODD + [(906, [0.0] * 6), (907, [-0.0] * 6)])
    got = polytope.nearest(df, F.col("vec_id") % 10 == 0, bucket_rows=bucket_rows, piece_rows=64).collect()
    scaled = [(i, [x / max(map(abs, v)) for x in v]) for i, v in rows]
    assert recall(got, brute(scaled, lambda ids: ids % 10 == 0)) >= 0.9


def test_few_candidates_are_all_found(spark):
    rows = [(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 1.0]), (0, [0.0, -1.0])]
    got = polytope.nearest(frame(spark, rows), F.col("vec_id") == 0).collect()
    assert sorted((r["rank"], r["vec_id"], round(r["score"], 9)) for r in got) == [(1, 1, 0.0), (1, 2, 0.0), (2, 1, -1.0), (2, 2, -1.0)]
    for few in ([], [(0, [1.0])], [(1, [1.0]), (2, [1.0])]):
        assert polytope.nearest(frame(spark, few), F.col("vec_id") == 0).collect() == []


def whitened(rows, k=4):
    """By numpy: n, eigenvalue shares, and per row its deviation and coordinates up to sign."""
    width = max(len(v) for _, v in rows)
    x = np.array([np.floor(256 * np.array(list(v) + [0.0] * (width - len(v)))) for _, v in rows]).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1][:, :k]
    away = n * x - sums
    return n, values[:k] / values.sum(), (away * away).sum(axis=1), (x - sums / n) @ vectors / np.sqrt(values[:k])


@pytest.mark.parametrize("block", [(1024, 1024), (16, 4)])
def test_whitening_against_numpy(spark, block):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(9) * np.arange(1, 10) / 3).tolist()) for i in range(200)]
    rows += [(500 + i, rows[0][1]) for i in range(100)] + [(700, [1.0, 2.0]), (701, [-0.0] * 9), (None, rows[1][1])]
    got = whitening.whiten(frame(spark, rows + [r for r in ODD if r[0] is not None and r[1] != []]), block_rows=block[0], block_columns=block[1])
    got = sorted(got.collect(), key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0))
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    n, shares, deviation, coordinates = whitened(rows)
    assert [r["vec_id"] for r in got] == [i for i, _ in rows]
    mine = np.array([r["whitened"] for r in got])
    signs = np.sign((mine * coordinates).sum(axis=0))
    assert np.allclose(mine * signs, coordinates, rtol=1e-9, atol=1e-9)
    assert [r["deviation"] for r in got] == deviation.tolist() and {r["n"] for r in got} == {n}
    assert np.allclose(got[0]["explained"], shares, rtol=1e-12) and got[0]["identity_error"] < 1e-9


def test_whitening_query(spark):
    got = registered()["op13_whitening"](spark, SMALL).collect()
    ids = [r["vec_id"] for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert sorted((r["vec_id"], r["component"]) for r in got) == sorted((i, c) for i in ids for c in range(1, 5))


def test_whitening_without_variance(spark):
    for rows in ([(1, [0.5, 1.0])] * 3, [(1, []), (2, [])], [(1, [1e19]), (2, [1.0])]):
        got = whitening.whiten(frame(spark, rows)).collect()
        assert len(got) == len(rows)
        assert all(len(r["whitened"]) == (rows[0][1] == [1e19]) for r in got)
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, ODD[:4])).collect() == []

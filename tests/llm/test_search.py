"""Exact top-k search against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from obslake.llm import nearest


def brute(rows, asked, k, scale):
    usable = {}
    for vec_id, vector in rows:
        if vec_id is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            usable.setdefault((vec_id, tuple(int(np.floor(x * scale)) for x in vector)), None)
    found = set()
    for q, v in usable:
        if asked(q):
            scores = [(-sum(a * b for a, b in zip(v, w)), c) for c, w in usable if c != q]
            found |= {(q, rank, c, -s) for rank, (s, c) in enumerate(sorted(scores)[:k], 1)}
    return found


def vectors(rng: random.Random, n: int, clusters: int):
    centres = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(clusters)]
    return [(i, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("annulus, fan", [(3, 64), (3, 2), (3, 5), (40, 64), (40, 3), (5000, 64)])
def test_against_brute_force(spark, annulus, fan):
    rng = random.Random(annulus)
    rows = vectors(rng, 300, 7)
    rows += [(1000 + i, rows[5][1]) for i in range(60)]  # many equal vectors
    rows += [(2000, None), (2010, [1.0, None, 0.0]), (2020, [float("nan")] * 6), (2030, [float("inf")] * 6), (None, [1.0] * 6)]
    rows += [rows[0], rows[0], (3000, [1.0, 2.0]), (3010, [0.0] * 6), (3020, [])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, _v string, score int")
    got = nearest.top_k(df, F.col("vec_id") % 10 == 0, pivots=4, annulus_rows=annulus, first=1, fan=fan)
    assert {tuple(r) for r in got.collect()} == brute(rows, lambda i: i % 10 == 0, 5, 256)


def test_ids_with_many_vectors_get_all_their_hits(spark):
    rng = random.Random(12)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(1, 60)]
    rows += [(0, [5 + rng.random(), 5.0, 5.0, 5.0]) for _ in range(9)]  # their best hits are each other
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest.top_k(df, F.col("vec_id") == 0, pivots=3, annulus_rows=8, first=1).collect()
    assert len(got) == 9 * 5 and {tuple(r) for r in got} == brute(rows, lambda i: i == 0, 5, 256)


def test_many_queries_of_an_annulus_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(nearest, "PIECE", 10)
    rows = vectors(random.Random(4), 120, 5)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest.top_k(df, F.col("vec_id") % 2 == 0, pivots=3, annulus_rows=15, first=1, fan=2)
    assert {tuple(r) for r in got.collect()} == brute(rows, lambda i: i % 2 == 0, 5, 256)


def test_few_candidates_and_odd_tables(spark):
    shape = "vec_id long, embedding array<float>"
    ask = F.col("vec_id") % 2 == 0
    assert nearest.top_k(spark.createDataFrame([], shape), ask).collect() == []
    assert nearest.top_k(spark.createDataFrame([(1, [1.0])], shape), ask).collect() == []
    assert nearest.top_k(spark.createDataFrame([(2, [1.0])], shape), ask).collect() == []
    got = nearest.top_k(spark.createDataFrame([(2, [1.0]), (3, [-1.0]), (4, [0.5])], shape), ask).collect()
    assert sorted(map(tuple, got)) == [(2, 1, 4, 32768), (2, 2, 3, -65536), (4, 1, 2, 32768), (4, 2, 3, -32768)]


def test_large_components_stay_exact(spark):
    rng = random.Random(9)
    rows = [(i, [float(rng.randint(-(10**6), 10**6)) for _ in range(3)]) for i in range(40)]
    got = nearest.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") < 5, k=3)
    assert {tuple(r) for r in got.collect()} == brute(rows, lambda i: i < 5, 3, 256)

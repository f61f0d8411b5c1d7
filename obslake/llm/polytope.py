"""Approximate nearest neighbours by cosine over cross-polytope hashing.

Unit vectors are turned by seeded pseudo-rotations (three rounds of random signs and a fast
Hadamard transform); a hash is the signed axis nearest to what comes out. Several tables,
each with hashes of its own, hold all vectors by bucket. A query first reads its most
likely buckets in every table. The k-th cosine found so far says how many more it needs: the
model of the hash alone, simulated over random pairs, gives the number of probes behind
which a vector of that cosine is found with the wanted probability. Candidates are ranked by
their exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.nearest import usable
from obslake.session import stored

MODEL_PAIRS = 400  # simulated pairs a cosine; no rows of a table are sampled
COSINES = np.linspace(0.0, 1.0, 41)
ASKED_TOGETHER = 4096  # queries
MARGIN = 2  # further rows kept before scores are taken again, pair by pair
HASHES = 3  # at most, a table


def _doubles(column: pa.Array, width: int) -> np.ndarray:
    """Rows of doubles, shorter ones filled with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _units(vectors: np.ndarray) -> np.ndarray:
    """Length one; scaled first, so that no square over- or underflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, initial=0, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows (a power of two long) times the orthonormal Hadamard matrix, by butterflies."""
    rows, wide = x.shape
    half = 1
    while half < wide:
        pairs = x.reshape(rows, wide // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        half *= 2
    return x.reshape(rows, wide) / np.sqrt(wide)


class Hashes:
    """``tables`` times ``each`` cross-polytope hashes of vectors up to ``width`` long."""

    def __init__(self, width: int, tables: int, each: int, seed: int) -> None:
        self.wide = 1 << max(1, (width - 1).bit_length())
        self.tables, self.each, self.buckets = tables, each, (2 * self.wide) ** each
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, each, 3, self.wide))

    def axes(self, units: np.ndarray, table: int) -> list[np.ndarray]:
        """Per hash of a table how near each signed axis is to the turned vectors."""
        filled = np.zeros((len(units), self.wide))
        filled[:, : units.shape[1]] = units
        found = []
        for signs in self.signs[table]:
            turned = filled
            for sign in signs:
                turned = hadamard(turned * sign)
            found.append(np.hstack([turned, -turned]))
        return found

    def own(self, units: np.ndarray, table: int) -> np.ndarray:
        """The bucket of each vector."""
        code = np.zeros(len(units), np.int64)
        for near in self.axes(units, table):
            code = code * (2 * self.wide) + near.argmax(axis=1)
        return code

    def probes(self, unit: np.ndarray, table: int, since: int, until: int) -> np.ndarray:
        """Buckets of one vector in falling likelihood, from number ``since`` to ``until``."""
        total, codes = np.zeros(1), np.zeros(1, np.int64)
        for near in self.axes(unit[None], table):
            best = np.argsort(-near[0], kind="stable")[:until]  # no later axis is in the first ``until``
            total = (total[:, None] + near[0][best]).ravel()
            codes = (codes[:, None] * (2 * self.wide) + best).ravel()
            first = np.argsort(-total, kind="stable")[:until]
            total, codes = total[first], codes[first]
        return codes[since:until]

    def needed(self, wanted: float, pairs: int = MODEL_PAIRS) -> np.ndarray:
        """For each of ``COSINES`` the probes a table after which a share ``wanted`` is found."""
        rng = np.random.default_rng(1)
        unit = lambda: _units(rng.standard_normal((pairs, self.wide)))
        ranks = np.full((len(COSINES), pairs), self.buckets, np.int64)
        for _ in range(self.tables):
            asked, away = [unit() for _ in range(self.each)], [unit() for _ in range(self.each)]
            away = [_units(a - (a * q).sum(axis=1, keepdims=True) * q) for q, a in zip(asked, away)]
            axes = [np.hstack([q, -q]) for q in asked]
            for at, cosine in enumerate(COSINES):
                there = [cosine * q + np.sqrt(1 - cosine**2) * a for q, a in zip(asked, away)]
                own = [np.hstack([t, -t]).argmax(axis=1) for t in there]
                reached = sum(a[np.arange(pairs), o] for a, o in zip(axes, own))
                ranks[at] = np.minimum(ranks[at], _better(axes, reached))
        return np.minimum(np.quantile(ranks, wanted, axis=1, method="higher").astype(np.int64) + 1, self.buckets)


def _better(axes: list[np.ndarray], reached: np.ndarray) -> np.ndarray:
    """Per row how many sums of one axis a hash are above what was reached."""
    if len(axes) == 1:
        return (axes[0] > reached[:, None]).sum(axis=1)
    last = np.sort(axes[-1], axis=1)
    rest = axes[0] if len(axes) == 2 else (axes[0][:, :, None] + axes[1][:, None, :]).reshape(len(reached), -1)
    return np.array(
        [len(b) * len(a) - np.searchsorted(b, r - a, side="right").sum() for a, b, r in zip(rest, last, reached)]
    )


_HITS = "_n long, _hit long, _score double"


def _best_hits(number: np.ndarray, asked: np.ndarray, there: np.ndarray, ids: list[list[int]], keep: int) -> pa.RecordBatch:
    """For each asked unit vector its ``keep`` nearest among those there."""
    out: list[list[np.ndarray]] = [[], [], []]
    sizes = np.array([len(x) for x in ids], np.int64)
    flat, begin = np.concatenate([np.asarray(x, np.int64) for x in ids]), np.cumsum(sizes) - sizes
    most = keep + MARGIN
    for at in range(0, len(asked), 256):
        part = asked[at : at + 256]
        scores = part @ there.T
        near = np.argpartition(-scores, most - 1, axis=1)[:, :most] if len(there) > most else np.tile(np.arange(len(there)), (len(part), 1))
        exact = np.clip(np.einsum("qd,qcd->qc", part, there[near]), -1.0, 1.0)
        for row, (found, score) in enumerate(zip(near, exact)):
            hit = np.concatenate([flat[begin[i] : begin[i] + sizes[i]] for i in found])
            score = np.repeat(score, sizes[found])
            best = np.lexsort((hit, -score))[:keep]
            for kept, values in zip(out, (np.full(len(best), number[at + row]), hit[best], score[best])):
                kept.append(values)
    columns = [np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(out, (np.int64, np.int64, np.float64))]
    return pa.record_batch(dict(zip(("_n", "_hit", "_score"), map(pa.array, columns))))


def _kept(hits: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` best of each query, cut before the shuffle as well; hits of several tables once."""
    nth = F.row_number().over(Window.partitionBy("_n").orderBy(F.desc("_score"), "_hit"))
    once = hits.groupBy("_n", "_hit").agg(F.max("_score").alias("_score"))
    return once.withColumn("_nth", nth).where(F.col("_nth") <= keep).drop("_nth")


def nearest(
    df: DataFrame,
    queries: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    tables: int = 4,
    first: int = 4,
    wanted: float = 0.97,
    bucket_rows: int = 1024,
    piece_rows: int = 4096,
    seed: int = 12,
) -> DataFrame:
    """Per query row ``k`` rows of large cosine: query_id, rank, vec_id, score.

    ``queries`` is a condition on ``df``; every other usable row is a candidate and is
    indexed. ``score`` is the exact cosine in double precision, ties go to the smaller id.
    The hashes are fitted on no rows; a table has as many hashes as make buckets of at
    most ``bucket_rows`` vectors on average (three at most). After ``first`` probes a table
    a query makes as many as find a vector as near as its k-th so far with probability
    ``wanted``. A query whose probes would add up to a whole table, or that has not found
    k yet, reads all buckets of one table: so all candidates are found where they are few.
    No bucket is capped: large ones are cut into pieces that are all read.

    Rows with a null id, a null or zero vector, or a null or non-finite component take no
    part. Shorter vectors count as filled up with zeros. Equal rows count once, equal
    vectors are read once; an id with several vectors is never its own neighbour. Other
    columns do not matter. An empty table, or no query, gives an empty result.
    """
    spark = df.sparkSession
    doubles = F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0))
    some = usable(F.col("_x")) & F.coalesce(F.exists("_x", lambda x: x != 0), F.lit(False))
    rows = df.select(F.col(vec_id).cast("long").alias("_id"), F.col(vector).alias("_x"), doubles.alias("_v"), F.coalesce(queries, F.lit(False)).alias("_query"))
    rows = stored(rows.where(F.col("_id").isNotNull() & some).select("_id", "_v", "_query").distinct(), "vectors")
    own = rows.groupBy("_id").agg(F.max("_query").alias("_query"), F.count_distinct("_v").alias("_n"))
    keep = k + (own.where("_query").agg(F.max("_n")).first()[0] or 0)
    # Of equal vectors nobody needs more than the ``keep`` smallest ids.
    nth = F.row_number().over(Window.partitionBy("_v").orderBy("_id"))
    smallest = (
        rows.select("_v", "_id").distinct().withColumn("_nth", nth).where(F.col("_nth") <= keep)
        .groupBy("_v").agg(F.array_sort(F.collect_list("_id")).alias("_ids"))
    )
    asked = rows.where("_query").select("_v").distinct().withColumn("_asked", F.lit(True))
    distinct = smallest.join(asked, "_v", "left").select(F.monotonically_increasing_id().alias("_n"), "*")
    distinct = stored(distinct, "distinct-vectors")
    n, width, n_asked = distinct.agg(F.count(F.lit(1)), F.max(F.size("_v")), F.count("_asked")).first()
    if not n or not n_asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    each = 1
    while each < HASHES and n > bucket_rows * Hashes(width, 1, each, seed).buckets:
        each += 1
    hashes = Hashes(width, tables, each, seed)
    needed = hashes.needed(wanted)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                units = _units(_doubles(batch.column("_v"), width))
                for table in range(tables):
                    code = pa.array(table * hashes.buckets + hashes.own(units, table))
                    yield pa.record_batch([batch.column("_v"), batch.column("_ids"), code], names=["_v", "_ids", "_code"])

    index = distinct.select("_v", "_ids").mapInArrow(hashed, "_v array<double>, _ids array<long>, _code long")
    pieces = max(1, -(-n * tables // piece_rows))
    index = index.repartitionByRange(pieces, F.col("_code"), F.xxhash64("_v"))
    index = stored(index.withColumn("_piece", F.spark_partition_id()), "buckets")
    directory = stored(index.select("_code", "_piece").distinct(), "bucket-directory")

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per query and bucket to read: its number, the bucket."""
        for batch in batches:
            vectors = _units(_doubles(batch.column("_v"), width)) if batch.num_rows else []
            since, until = batch.column("_since").to_pylist(), batch.column("_until").to_pylist()
            for number, unit, low, high in zip(batch.column("_n").to_pylist(), vectors, since, until):
                parts = [table * hashes.buckets + hashes.probes(unit, table, low, high) for table in range(tables)]
                codes = np.concatenate(parts)
                yield pa.record_batch({"_n": pa.array(np.full(len(codes), number)), "_code": pa.array(codes)})

    def read(probes: DataFrame) -> DataFrame:
        """The best of each piece for each query that asks for its bucket."""
        pairs = probes.join(directory, "_code")
        many = pairs.groupBy("_code", "_piece").agg(F.ceil(F.count(F.lit(1)) / ASKED_TOGETHER).cast("int").alias("_parts"))
        block = F.pmod(F.xxhash64("_n"), F.col("_parts")).cast("int").alias("_block")
        asking = pairs.join(many, ["_code", "_piece"]).select("_n", "_code", "_piece", block)
        asking = asking.join(distinct.where("_asked").select("_n", "_v"), "_n")
        there = index.join(many, ["_code", "_piece"]).select(
            "_v", "_ids", "_code", "_piece", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_block")
        )
        key = ("_code", "_piece", "_block")

        def ranked(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return empty
            units = [_units(_doubles(t.column("_v").combine_chunks(), width)) for t in (left, right)]
            number = left.column("_n").to_numpy()
            return pa.Table.from_batches([_best_hits(number, *units, right.column("_ids").to_pylist(), keep)])

        return asking.groupBy(*key).cogroup(there.groupBy(*key)).applyInArrow(ranked, _HITS)

    empty = pa.table({"_n": pa.array([], pa.int64()), "_hit": pa.array([], pa.int64()), "_score": pa.array([], pa.float64())})
    questions = distinct.where("_asked").select("_n", "_v")
    begin = min(first, hashes.buckets)
    start = questions.withColumns({"_since": F.lit(0).cast("long"), "_until": F.lit(begin).cast("long")})
    shape = "_n long, _code long"
    found = stored(_kept(read(start.mapInArrow(probed, shape)), keep), "first-hits")

    worst = found.groupBy("_n").agg(F.count(F.lit(1)).alias("_found"), F.min("_score").alias("_worst"))
    step = F.floor(F.greatest(F.lit(0.0), F.col("_worst")) * (len(COSINES) - 1)).cast("int")
    until = F.when(
        (F.coalesce(F.col("_found"), F.lit(0)) < keep) | (F.col("_worst") <= 0), F.lit(hashes.buckets)
    ).otherwise(F.element_at(F.array(*map(F.lit, needed.tolist())), step + 1).cast("bigint"))
    more = stored(
        questions.join(worst, "_n", "left").select("_n", "_v", F.lit(begin).cast("long").alias("_since"), until.cast("long").alias("_until")),
        "further-probes",
    )
    whole = F.col("_until") * tables >= hashes.buckets
    some_more = more.where(~whole & (F.col("_until") > begin)).mapInArrow(probed, shape)
    # By their first axis, so that a query names few keys; buckets without vectors are not named.
    axis = F.expr(f"_code div {hashes.buckets // (2 * hashes.wide)}")
    of_one_table = directory.where(F.col("_code") < hashes.buckets).select("_code", axis.alias("_axis")).distinct()
    axes = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2 * hashes.wide - 1).cast("long"))).alias("_axis")
    everything = more.where(whole).select("_n", axes).join(of_one_table, "_axis").select("_n", "_code")
    hits = found.unionByName(read(some_more)).unionByName(read(everything))
    best = _kept(hits, keep)

    others = (
        rows.where("_query").join(distinct.select("_v", "_n"), "_v").select(F.col("_id").alias("query_id"), "_n")
        .join(best, "_n").where(F.col("_hit") != F.col("query_id"))
    )
    rank = F.row_number().over(Window.partitionBy("query_id", "_n").orderBy(F.desc("_score"), "_hit"))
    ranked = others.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("_hit").alias("vec_id"), F.col("_score").alias("score"))

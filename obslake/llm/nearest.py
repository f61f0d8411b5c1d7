"""Exact top-k search by inner product over a pivot-distance index.

Components become integers, and one more coordinate sqrt(M^2 - |v|^2) gives all vectors
the same length M, so that a larger inner product is a smaller distance. Vectors are
keyed by their nearest pivot and their distance to it; sorted by that key they are cut
into annuli, and runs of annuli into a tree. A query is first answered from the annulus it lies
in, then from the few annuli nearest to it, and then from all those that the triangle
inequality cannot rule out with the k-th score found so far; these it finds by going down
the tree, so that it meets few that are ruled out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.session import stored

PIECE = 4096
SLACK = 1e-6  # relative; distances are doubles


def quantised(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))


def usable(vector: Column) -> Column:
    """Neither null nor holding null, NaN or infinite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of integers, shorter ones filled with zeros; doubles where they are exact."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    largest = float(np.abs(out).max(initial=0))
    return out.astype(np.float64) if largest * largest * max(1, width) < 2.0**53 else out


def _distances(vectors: np.ndarray, pivots: np.ndarray, longest: float, query: bool) -> np.ndarray:
    """Distances to the pivots in the space with the added coordinate (0 for queries)."""
    v, p = vectors.astype(np.float64), pivots.astype(np.float64)
    added = lambda x: np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0))
    own = np.zeros(len(v)) if query else added(v)
    square = (v * v).sum(axis=1)[:, None] + (p * p).sum(axis=1) - 2 * v @ p.T
    return np.sqrt(np.maximum(square + (own[:, None] - added(p)[None, :]) ** 2, 0))


def _best(scores: np.ndarray, ids: list[list[int]], keep: int) -> list[tuple[list[int], list[int]]]:
    """Per row of scores the ``keep`` best (score, id), ids ascending among equals."""
    sizes = np.array([len(x) for x in ids])
    flat = np.concatenate([np.asarray(x, np.int64) for x in ids]) if len(ids) else np.zeros(0, np.int64)
    result = []
    for row in scores:
        if len(row) > 4 * keep:
            near = np.flatnonzero(row >= np.partition(row, len(row) - keep)[len(row) - keep])
        else:
            near = np.arange(len(row))
        values = np.repeat(row[near], sizes[near]).astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        found = np.concatenate([flat[begin[i] : begin[i] + sizes[i]] for i in near]) if len(near) else flat
        order = np.lexsort((found, -values))[:keep]
        result.append((values[order].tolist(), found[order].tolist()))
    return result


_FOUND = "_v array<bigint>, _scores array<bigint>, _ids array<bigint>"


def _found_batch(vectors: pa.Array, best: list, extra: dict | None = None) -> pa.RecordBatch:
    longs = pa.list_(pa.int64())
    columns = {"_v": vectors, "_scores": pa.array([b[0] for b in best], longs), "_ids": pa.array([b[1] for b in best], longs)}
    columns |= extra or {}
    return pa.record_batch(list(columns.values()), names=list(columns))


def _merged(found: DataFrame, keep: int) -> DataFrame:
    """One row per query vector: its best scores and ids over all rows found so far."""
    pairs = F.transform(F.arrays_zip("_scores", "_ids"), lambda x: F.struct((-x["_scores"]).alias("s"), x["_ids"].alias("i")))
    best = F.slice(F.array_sort(F.flatten(F.collect_list("_pairs"))), 1, keep)
    return (
        found.withColumn("_pairs", pairs)
        .groupBy("_v")
        .agg(best.alias("_best"))
        .select("_v", F.transform("_best", lambda x: -x["s"]).alias("_scores"), F.transform("_best", lambda x: x["i"]).alias("_ids"))
    )


def top_k(
    df: DataFrame,
    queries: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    scale: int = 256,
    pivots: int = 16,
    annulus_rows: int = 2048,
    first: int = 3,
    fan: int = 64,
) -> DataFrame:
    """Per query row its ``k`` largest integer inner products: query_id, rank, vec_id, score.

    ``queries`` is a condition on ``df``; every other usable row is a candidate. Components
    become floor(scale * x). Ties go to the smaller id; with fewer candidates there are
    fewer rows. The index is fitted on ``pivots`` vectors and holds all of them.

    Rows with a null id, a null vector, or a null or non-finite component take no part.
    Shorter vectors count as filled up with zeros. Equal rows count once; an id with
    several vectors is never its own neighbour. Other columns do not matter. An empty
    table, or no query, gives an empty result.
    """
    spark = df.sparkSession
    rows = df.select(
        F.col(vec_id).cast("long").alias("_id"), F.col(vector).alias("_x"), F.coalesce(queries, F.lit(False)).alias("_query")
    ).where(F.col("_id").isNotNull() & usable(F.col("_x")))
    rows = stored(
        rows.select("_id", quantised(F.col("_x"), scale).alias("_v"), "_query").distinct(), "vectors"
    )
    # As many of the best rows as a query id has vectors may be its own.
    own = rows.groupBy("_id").agg(F.max("_query").alias("_query"), F.count_distinct("_v").alias("_n"))
    keep = k + (own.where("_query").agg(F.max("_n")).first()[0] or 0)
    # Equal vectors are one candidate: nobody needs more than the ``keep`` smallest ids of them.
    nth = F.row_number().over(Window.partitionBy("_v").orderBy("_id"))
    smallest = (
        rows.select("_v", "_id").distinct().withColumn("_nth", nth).where(F.col("_nth") <= keep)
        .groupBy("_v").agg(F.array_sort(F.collect_list("_id")).alias("_ids"))
    )
    asked = rows.where("_query").select("_v").distinct().withColumn("_asked", F.lit(True))
    # The query vectors come from the same table, so this join never matches a key twice.
    distinct = stored(smallest.join(asked, "_v", "left"), "distinct-vectors")
    square = F.aggregate("_v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    n, width, longest, n_asked = distinct.agg(
        F.count(F.lit(1)), F.max(F.size("_v")), F.max(square), F.count("_asked")
    ).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n or not n_asked:
        return empty
    # A fixed number of vectors, whatever the size of the table.
    chosen = distinct.select("_v").orderBy(F.xxhash64("_v"), "_v").limit(pivots).collect()
    centres = np.zeros((len(chosen), width))
    for i, r in enumerate(chosen):
        centres[i, : len(r["_v"])] = r["_v"]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            away = _distances(_matrix(batch.column("_v"), width), centres, longest, query=False)
            nearest = away.argmin(axis=1)
            new = [pa.array(nearest, pa.int32()), pa.array(away[np.arange(len(nearest)), nearest])]
            yield pa.record_batch([*batch.columns, *new], names=[*batch.schema.names, "_pivot", "_away"])

    parts = max(1, -(-n // annulus_rows))
    index = distinct.mapInArrow(
        keyed, "_v array<bigint>, _ids array<bigint>, _asked boolean, _pivot int, _away double"
    )
    index = stored(
        index.repartitionByRange(parts, "_pivot", "_away")
        .withColumn("_annulus", F.spark_partition_id().cast("long") * len(chosen) + F.col("_pivot")),
        "annuli",
    )
    # A node is (_node, _pivot): the pivot's vectors in fan^level neighbouring ranges. Few are at the top.
    spread_of = [F.min("_low").alias("_low"), F.max("_high").alias("_high")]
    ranges = index.select(F.floor(F.col("_annulus") / len(chosen)).alias("_node"), "_pivot", F.col("_away").alias("_low"), F.col("_away").alias("_high"))
    tree = [stored(ranges.groupBy("_node", "_pivot").agg(*spread_of), "annulus-directory")]
    while parts > fan ** len(tree):
        wider = tree[-1].withColumn("_node", F.floor(F.col("_node") / fan))
        tree.append(stored(wider.groupBy("_node", "_pivot").agg(*spread_of), "annulus-directory"))

    def search(table: pa.Table, vectors: pa.ChunkedArray) -> Iterator[pa.RecordBatch]:
        data = _matrix(table.column("_v"), width)
        ids = table.column("_ids").to_pylist()
        for at in range(0, len(vectors), 256):
            part = vectors.slice(at, 256).combine_chunks()
            yield _found_batch(part, _best(_matrix(part, width) @ data.T, ids, keep))

    def at_home(table: pa.Table) -> pa.Table:
        mine = table.filter(table.column("_asked").is_valid())
        return pa.Table.from_batches(search(table, mine.column("_v")), schema=found_schema)

    longs = pa.list_(pa.int64())
    found_schema = pa.schema([("_v", longs), ("_scores", longs), ("_ids", longs)])
    best = stored(index.groupBy("_annulus").applyInArrow(at_home, _FOUND), "found-at-home")
    home = index.where("_asked").select("_v", F.col("_annulus").alias("_home"))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per query and pivot: distance, and the radius that could still hold a better one."""
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column("_v"), width)
            away = _distances(v, centres, longest, query=True)
            scores = batch.column("_scores").to_pylist()
            worst = np.array([s[-1] if len(s) >= keep else -np.inf for s in scores])
            radius = np.sqrt(np.maximum((v.astype(np.float64) ** 2).sum(axis=1) + longest - 2 * worst, 0))
            radius = radius * (1 + SLACK) + SLACK
            count = len(centres)
            row = pa.array(np.repeat(np.arange(len(v)), count))
            yield pa.record_batch(
                [
                    batch.column("_v").take(row), batch.column("_home").take(row),
                    pa.array(np.tile(np.arange(count, dtype=np.int32), len(v))),
                    pa.array(away.ravel()), pa.array(np.repeat(radius, count)),
                ],
                names=["_v", "_home", "_pivot", "_far", "_radius"],
            )

    def open_annuli(best: DataFrame) -> DataFrame:
        """Query vectors with each annulus the triangle inequality leaves open, and its bound."""
        spans = best.join(home, "_v").select("_v", "_scores", "_home").mapInArrow(
            reach, "_v array<bigint>, _home bigint, _pivot int, _far double, _radius double"
        )
        bound = F.greatest(F.col("_low") - F.col("_far"), F.col("_far") - F.col("_high"), F.lit(0.0))
        reached = spans.withColumn("_above", F.lit(0).cast("bigint"))
        for level in reversed(tree):
            above = F.floor(F.col("_node") / fan) if level is not tree[-1] else F.lit(0).cast("bigint")
            reached = (
                reached.join(level.withColumn("_above", above), ["_pivot", "_above"])
                .withColumn("_bound", bound).where("_bound <= _radius")
                .select("_v", "_home", "_pivot", "_far", "_radius", "_bound", F.col("_node").alias("_above"))
            )
        annulus = F.col("_above") * len(chosen) + F.col("_pivot")
        return reached.select("_v", annulus.alias("_annulus"), "_home", "_bound").where("_annulus <> _home").drop("_home")

    def visit(pairs: DataFrame) -> DataFrame:
        """Search the annuli of the pairs; many queries of one annulus are cut into pieces.

        An annulus goes only to the pieces that ask for it.
        """
        pieces = max(1, -(-n_asked // PIECE))
        pairs = pairs.withColumn("_piece", F.pmod(F.xxhash64("_v"), F.lit(pieces)).cast("int"))
        asking = pairs.select("_annulus", F.col("_piece").alias("_asking")).distinct()
        copies = index.join(asking, "_annulus")
        return pairs.groupBy("_annulus", "_piece").cogroup(
            copies.groupBy("_annulus", "_asking")
        ).applyInArrow(
            lambda asking, there: pa.Table.from_batches(
                search(there, asking.column("_v")) if asking.num_rows else [], schema=found_schema
            ),
            _FOUND,
        )

    near = F.row_number().over(Window.partitionBy("_v").orderBy("_bound", "_annulus"))
    visited = stored(
        open_annuli(best).withColumn("_nth", near).where(F.col("_nth") <= first).select("_v", "_annulus"), "visited"
    )
    best = stored(_merged(best.unionByName(visit(visited)), keep), "found-near")
    rest = open_annuli(best).select("_v", "_annulus").join(visited, ["_v", "_annulus"], "left_anti")
    rest = stored(rest, "left-open")
    best = _merged(best.unionByName(visit(rest)), keep)

    others = F.filter(F.arrays_zip("_scores", "_ids"), lambda x: x["_ids"] != F.col("_id"))
    return (
        rows.where("_query").select("_id", "_v").join(best, "_v")
        .select(F.col("_id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("_at", "_hit"))
        .select("query_id", (F.col("_at") + 1).alias("rank"), F.col("_hit._ids").alias("vec_id"), F.col("_hit._scores").alias("score"))
    )

"""Keys: deduplication, dimensions, surrogates, resolution, idempotent inserts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.operators.ordered import exact_key
from obslake.session import new_path, stored


def keep_first(df: DataFrame, key: Sequence[str], prefer: Sequence[Column] = (), few: int = 100_000) -> DataFrame:
    """One row per key: the smallest by ``prefer``, then by the remaining columns.

    In two steps. A hash aggregate over the key and the first ranking column finds the keys
    that rows share, and writes them down; copies of a key held by a third of all rows
    collapse before its shuffle. Are they ``few``, rows of other keys pass as they are, and of
    the shared keys only rows that tie in the first ranking column are compared by the rest;
    ``df`` is read three times, the first time without the columns that do not matter there.

    More of them would not fit a broadcast, and joins would send all rows twice. Then all rows
    are ranked by key in one shuffle, to which a task sends only the first it has of each key.
    """
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.select(*key).distinct()
    names = [f"_p{i}" for i in range(len(prefer))]
    ranked = df.withColumns(dict(zip(names, prefer)))
    ranked = ranked.withColumn("_first", exact_key(ranked, [*names, *rest][0]))
    shared = ranked.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_first").alias("_least"), F.max(F.col("_first").isNull()).alias("_null")
    )
    shared = stored(shared.where("_rows > 1"), "shared-keys")
    if shared.count() > few:
        order = Window.partitionBy(*key).orderBy(*names, *rest)
        ranked = df.withColumns(dict(zip(names, prefer))).withColumn("_at", F.row_number().over(order))
        return ranked.where("_at = 1").select(*df.columns)
    same = reduce(and_, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in key])
    alone = df.alias("a").join(shared.alias("b"), same, "left_anti")
    # A null is less than any value.
    least = F.when(F.col("_null"), F.col("_first").isNull()).otherwise(F.col("_first") == F.col("_least"))
    tied = ranked.alias("a").join(shared.alias("b"), same).where(least).select("a.*")
    first = tied.groupBy(*key).agg(F.min(F.struct(*names, *rest)).alias("_row"))
    return alone.unionByName(first.select(*key, *[F.col("_row")[c].alias(c) for c in rest]))


def derive_dimension(
    df: DataFrame, key: Sequence[str], moment: str, start: str, end: str
) -> DataFrame:
    """One row per natural key with its first and last moment."""
    return df.groupBy(*key).agg(F.min(moment).alias(start), F.max(moment).alias(end))


def distinct_pairs(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct key combinations, to be checked for uniqueness before loading."""
    return df.select(*key).distinct()


def number_rows(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Dense 1-based ids in the order of a unique natural key.

    The rows are range-partitioned, sorted and written to the shared folder; ids are
    the position in the part plus the sizes of the parts before it, so no task sees
    more than one part and a lost executor cannot change an id.
    """
    spark = df.sparkSession
    path = new_path(spark, "numbered")
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .write.parquet(path)
    )
    written = spark.read.parquet(path)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        written.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_offset", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .select("_part", "_offset")
    )
    position = (F.col("_offset") + F.col("_at") + 1).cast("bigint")
    # One row per part: no more than there are shuffle partitions, however large the data.
    return written.join(F.broadcast(offsets), "_part").select(position.alias(out), *df.columns)


def resolve_key(fact: DataFrame, dim: DataFrame, natural: Sequence[str], surrogate: str) -> DataFrame:
    """Attach the surrogate; rows without a dimension row keep NULL (see unresolved)."""
    return fact.join(dim.select(*natural, surrogate), list(natural), "left")


def unresolved(resolved: DataFrame, surrogate: str) -> DataFrame:
    """How many rows found no dimension row."""
    return resolved.agg(F.count_if(F.col(surrogate).isNull()).alias("unmatched_rows"))


def require_resolved(resolved: DataFrame, surrogate: str) -> DataFrame:
    """Refuse rows that found no dimension row: reading one ends the job with an error.

    The check is part of the plan, so the join behind it runs once.
    """
    refused = F.raise_error(F.lit(f"a row failed to match a {surrogate}"))
    kept = F.when(F.col(surrogate).isNull(), refused.cast(resolved.schema[surrogate].dataType))
    return resolved.withColumn(surrogate, kept.otherwise(F.col(surrogate)))


def absent_rows(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Source rows, one per key, whose key the target does not hold yet."""
    return keep_first(source, key).join(target.select(*key), list(key), "left_anti")


def union_keys(frames: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Distinct keys present in any of the frames."""
    merged = frames[0].select(*key)
    for frame in frames[1:]:
        merged = merged.unionByName(frame.select(*key))
    return merged.distinct()

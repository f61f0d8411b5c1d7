"""Summary statistics: correlation, tiers, boxes, indexing, marker scales, rankings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obslake.functions.numbers import area_size, min_max_index
from obslake.operators.ordered import exact_quantiles, join_null_safe, quantile_profiles
from obslake.session import stored

BOX_POINTS = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}


def correlations(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Pearson correlation per named pair over rows where both are present.

    Fewer than two such rows, or a constant column, gives NULL.
    """
    measures = []
    for name, (a, b) in pairs.items():
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x = F.when(both, F.col(a)).cast("double")
        y = F.when(both, F.col(b)).cast("double")
        # Not F.corr: under ANSI rules it fails on a constant column.
        spread = F.stddev_pop(x) * F.stddev_pop(y)
        measures.append(F.try_divide(F.covar_pop(x, y), spread).alias(name))
    return df.agg(*measures)


def tier_table(spark: SparkSession, tiers: Sequence[str], name: str) -> DataFrame:
    """Tiers with their position, so that reports keep the given order."""
    listed = F.posexplode(F.array(*[F.lit(t) for t in tiers]))
    return spark.range(1).select(listed.alias("tier_no", name))


def tier_means(df: DataFrame, tier: str, value: str, tiers: Sequence[str]) -> DataFrame:
    """Mean per tier in the given order; tiers without rows are kept with NULL."""
    total, count = F.sum(value).cast("double"), F.count(value)
    means = df.groupBy(tier).agg(F.try_divide(total, count).alias("mean_value"))
    return tier_table(df.sparkSession, tiers, tier).join(means, tier, "left")


def tier_boxes(df: DataFrame, tier: str, value: str) -> DataFrame:
    """Five-number summary with mean and count per tier, for tiers of any size.

    Count, sum, extremes and the windows of the quartiles come from one read, the exact
    quartiles from a second one.
    """
    inner = {name: p for name, p in BOX_POINTS.items() if 0 < p < 1}
    profiles = quantile_profiles(df, [tier], value, inner)
    boxes = exact_quantiles(df, [tier], value, inner, profiles=profiles)
    total = F.col("_total").cast("double")
    summary = profiles.where("_rows > 0").select(
        tier, F.col("_low").alias("low"), F.col("_high").alias("high"),
        F.col("_rows").alias("n_rows"), F.try_divide(total, F.col("_rows")).alias("mean_value"),
    )
    return boxes.join(summary, tier).select(tier, *BOX_POINTS, "n_rows", "mean_value")


def indexed(df: DataFrame, value: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """Value on a 0-100 scale between the series' own minimum and maximum."""
    return indexed_jointly(df, {value: out}, by)


def indexed_jointly(df: DataFrame, columns: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Several columns on one 0-100 scale between their common minimum and maximum.

    Bounds are aggregated per series first, so a long series is never gathered.
    """
    low, high = _common_bounds(list(columns))
    if by:
        bounds = df.groupBy(*by).agg(low.alias("_low"), high.alias("_high"))
        bounded = df.join(bounds, list(by))
    else:
        both = df.agg(F.struct(low.alias("low"), high.alias("high"))).scalar()
        bounded = df.withColumn("_bounds", both).select(
            *df.columns, F.col("_bounds.low").alias("_low"), F.col("_bounds.high").alias("_high")
        )
    scaled = {
        out: min_max_index(F.col(c).cast("double"), F.col("_low"), F.col("_high"))
        for c, out in columns.items()
    }
    return bounded.withColumns(scaled).drop("_low", "_high")


def _common_bounds(columns: Sequence[str]) -> tuple[Column, Column]:
    lows = [F.min(c).cast("double") for c in columns]
    highs = [F.max(c).cast("double") for c in columns]
    if len(columns) == 1:
        return lows[0], highs[0]
    return F.least(*lows), F.greatest(*highs)


def axis_range(df: DataFrame, columns: Sequence[str], padding: float) -> DataFrame:
    """Padded axis limits over several columns."""
    low, high = _common_bounds(columns)
    return df.agg((low - padding).alias("axis_low"), (high + padding).alias("axis_high"))


def marker_sizes(
    df: DataFrame, value: str, floor: float, span: float, empty: float, out: str = "marker_size"
) -> DataFrame:
    """Marker size with area proportional to the value, relative to the largest value.

    The rows are written down, so that they are made once for both.
    """
    df = stored(df, "sized")
    largest = df.agg(F.max(value)).scalar()
    return df.withColumn(out, area_size(F.col(value), largest, floor, span, empty))


def colour_cap(df: DataFrame, value: str, probability: float = 0.9) -> DataFrame:
    """The value at which a skewed colour scale saturates."""
    return exact_quantiles(df, [], value, {"colour_cap": probability})


def latest_rows(df: DataFrame, order: str, n: int, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """The n latest rows, rows without a time first, as a SQL server sorts them."""
    return df.orderBy(F.col(order).desc_nulls_first(), *tiebreak).limit(n)


def latest_per_entity(df: DataFrame, by: Sequence[str], order: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The last row of each entity, or of the whole table.

    A hash aggregate finds the last moment of every entity; only the rows at that moment,
    few of all, are compared by the columns that break ties. ``df`` is read twice.
    """
    last = F.max(order).alias("_latest")
    if by:
        known = stored(df.groupBy(*by).agg(last), "latest")
        late = join_null_safe(df, known, by).where(F.col(order).eqNullSafe(F.col("_latest"))).drop("_latest")
    else:
        late = df.where(F.col(order).eqNullSafe(F.lit(df.agg(last).first()[0])))
    rest = [c for c in df.columns if c not in by]
    found = F.max_by(F.struct(*rest), F.struct(order, *tiebreak)).alias("_last")
    return late.groupBy(*by).agg(found).where(F.col("_last").isNotNull()).select(*by, "_last.*").select(*df.columns)


def extremes(df: DataFrame, measure: str, n: int, tiebreak: str) -> DataFrame:
    """The n highest and n lowest rows of a ranking; a row in both appears once."""
    top = df.orderBy(F.col(measure).desc_nulls_first(), tiebreak).limit(n)
    bottom = df.orderBy(F.col(measure).asc_nulls_last(), F.col(tiebreak).desc()).limit(n)
    return top.unionByName(bottom).distinct()


def ids_by_group(
    df: DataFrame, by: str, identifier: str, separator: str = ", ", ids_per_part: int = 100_000
) -> DataFrame:
    """Sorted ids of each group as text, in parts 0, 1, 2 ... of ``ids_per_part``; repeats stay.

    Repeats are counted before the shuffle. The distinct ids are range-partitioned, sorted
    and written; an id's place in its group is its place in the written part and the ids of
    the parts before, so a part's text is the only thing a task ever gathers.
    """
    counted = df.groupBy(by, identifier).agg(F.count(F.lit(1)).alias("_n")).where(F.col(identifier).isNotNull())
    written = stored(
        counted.repartitionByRange(by, identifier).withColumn("_part", F.spark_partition_id()), "ids"
    )
    per_part = Window.partitionBy("_part", by)
    so_far = per_part.orderBy(identifier).rowsBetween(Window.unboundedPreceding, 0)
    sizes = written.groupBy("_part", by).agg(F.sum("_n").alias("_size"))
    earlier = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_part").alias("_at_part"), F.col(by).alias("_at_group"),
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
    )
    same = (F.col("_part") == F.col("_at_part")) & F.col(by).eqNullSafe(F.col("_at_group"))
    placed = (
        written.withColumn("_until", F.sum("_n").over(so_far))
        .join(offsets, same)
        .withColumn("_end", F.col("_before") + F.col("_until"))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )
    number = F.sequence(F.floor(F.col("_start") / ids_per_part), F.floor((F.col("_end") - 1) / ids_per_part))
    cut = placed.select(by, identifier, "_start", "_end", F.explode(number).alias("part"))
    copies = F.least("_end", (F.col("part") + 1) * ids_per_part) - F.greatest("_start", F.col("part") * ids_per_part)
    listed = F.array_sort(F.collect_list(F.struct(F.col(identifier).alias("id"), copies.cast("int").alias("n"))))
    text = F.transform(listed, lambda x: F.array_repeat(x["id"].cast("string"), x["n"]))
    return cut.groupBy(by, F.col("part").cast("int").alias("part")).agg(
        F.array_join(F.flatten(text), separator).alias("ids")
    )


def listed_for(groups: DataFrame, ids: DataFrame, by: str) -> DataFrame:
    """The id text for each given group, empty where the group has none."""
    listed = groups.select(by).join(ids, by, "left")
    return listed.withColumns(
        {"part": F.coalesce("part", F.lit(0)), "ids": F.coalesce("ids", F.lit(""))}
    )


def coverage_summary(df: DataFrame, entity: str, moment: str) -> DataFrame:
    """Rows, distinct entities, earliest and latest moment."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(entity).alias("n_entities"),
        F.min(moment).alias("earliest"),
        F.max(moment).alias("latest"),
    )

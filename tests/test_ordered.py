"""Range-wise operators give what plain windows give, whatever the skew."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from obslake.operators import ordered, panel, series
from tests.conftest import same

RANGES = [
    ordered.Ranges(),
    ordered.Ranges((500.0,)),
    ordered.Ranges((0.0, 100.0, 101.0, 5000.0)),
]


@pytest.fixture(scope="module")
def skewed(spark):
    """One entity and one narrow stretch of time hold far more than their share."""
    n = F.col("id")
    entity = F.when(n % 3 == 0, "hot").when(n % 7 == 0, F.lit(None)).otherwise((n % 11).cast("string"))
    at = F.when(n % 2 == 0, F.lit(100) + n / 10000).otherwise(n)
    return spark.range(4000).select(
        entity.alias("entity"), at.cast("double").alias("at"), "id", (n * 7919 % 1009).alias("v")
    )


@pytest.mark.parametrize("ranges", RANGES)
def test_lag(skewed, ranges):
    window = Window.partitionBy("entity").orderBy("at", "id")
    expected = skewed.withColumn("before", F.lag("v").over(window))
    got = ordered.lag_in_order(skewed, ["entity"], "at", "v", "before", ranges, ["id"])
    assert same(got, expected)


def test_lag_without_tiebreak_and_entity(skewed):
    window = Window.orderBy("at")
    expected = skewed.withColumn("before", F.lag("v").over(window))
    ranges = ordered.balanced_ranges(skewed, "at", 8)
    assert same(ordered.lag_in_order(skewed, [], "at", "v", "before", ranges), expected)


@pytest.mark.parametrize("ranges", RANGES)
def test_row_index(skewed, ranges):
    window = Window.partitionBy("entity").orderBy("at", "id")
    expected = skewed.withColumn("n", F.row_number().over(window).cast("bigint"))
    assert same(ordered.row_index(skewed, ["entity"], "at", "n", ranges, ["id"]), expected)


def test_edges_balance_a_crowded_stretch(skewed):
    ranges = ordered.balanced_ranges(skewed, "at", 10)
    sizes = ordered.with_ranges(skewed, "at", ranges).groupBy(ordered.RANGE).count().collect()
    assert len(sizes) >= 8
    assert max(r["count"] for r in sizes) <= 4000 / 10 * 1.5


def test_edges_of_one_value_and_no_rows(spark, skewed):
    assert len(ordered.balanced_ranges(skewed.withColumn("at", F.lit(1.0)), "at", 8).edges) <= 1
    assert ordered.balanced_ranges(skewed.where("false"), "at", 8) == ordered.Ranges()


def test_one_moment_with_half_of_all_rows_is_cut_by_the_tiebreak(skewed):
    n = F.col("id")
    tied = skewed.withColumn("at", F.when(n % 2 == 0, 77.0).otherwise(F.col("at")))
    ranges = ordered.balanced_ranges(tied, "at", 10, "id")
    assert len(ranges.crowded) == 1
    sizes = ordered.with_ranges(tied, "at", ranges, ["id"]).groupBy(ordered.RANGE).count().collect()
    assert max(r["count"] for r in sizes) <= 4000 / 10 * 1.5
    window = Window.partitionBy("entity").orderBy("at", "id")
    expected = tied.withColumn("before", F.lag("v").over(window))
    assert same(ordered.lag_in_order(tied, ["entity"], "at", "v", "before", ranges, ["id"]), expected)
    expected = tied.withColumn("n", F.row_number().over(window).cast("bigint"))
    assert same(ordered.row_index(tied, ["entity"], "at", "n", ranges, ["id"]), expected)


def test_ranges_of_days_shared_by_all_entities(spark):
    days = spark.range(3000).select((F.col("id") % 5).alias("at"), (F.col("id") % 600).alias("entity"))
    assert ordered.balanced_ranges(days, "at", 50).edges == (0.0, 1.0, 2.0, 3.0, 4.0)


def test_values_spread_over_many_powers(spark):
    """However far the values lie apart, the largest range stays near its target."""
    n = F.col("id")
    spread = spark.range(20_000).select(F.pow(F.lit(2.0), n % 150).alias("at"), (n * 7919 % 20_000).alias("id"))
    ranges = ordered.balanced_ranges(spread, "at", 64, "id")
    sizes = ordered.with_ranges(spread, "at", ranges, ["id"]).groupBy(ordered.RANGE).count().collect()
    assert max(r["count"] for r in sizes) <= 2 * 20_000 / 64


def test_rows_per_range(spark):
    even = spark.range(5000).withColumnRenamed("id", "at")
    assert ordered.balanced_ranges(even, "at") == ordered.Ranges()
    assert len(ordered.balanced_ranges(even, "at", rows_per_range=500).edges) == 9
    assert len(ordered.balanced_ranges(even, "at", rows_per_range=2).edges) > 1500


WIDE = 1 << 60


@pytest.mark.parametrize("tie", ["id", "name", "when"])
def test_foreign_ranges_and_wide_keys(spark, tie):
    """Keys beyond the reach of doubles, and ranges made for another table."""
    n = F.col("id")
    wide = spark.range(600).select(
        F.when(n % 2 == 0, WIDE).otherwise(F.lit(WIDE) + n % 7).cast("bigint").alias("at"), "id",
        F.when(n % 50 > 0, F.concat(F.lit("name "), n.cast("string"))).alias("name"),
        F.timestamp_micros(n * 1000 + n % 3).alias("when"), (n * 31 % 17).alias("v"),
    )
    foreign = wide.where("id < 300").withColumn("at", F.col("at") + 1)
    order = [tie, *(["id"] if tie == "name" else [])]
    window = Window.orderBy("at", *order)
    expected = wide.withColumn("before", F.lag("v").over(window))
    numbered = wide.withColumn("n", F.row_number().over(window).cast("bigint"))
    for made_for in (wide, foreign):
        ranges = ordered.balanced_ranges(made_for, "at", 12, tie)
        assert ranges.crowded and len(ranges.tie_edges) > 1
        assert same(ordered.lag_in_order(wide, [], "at", "v", "before", ranges, order), expected)
        assert same(ordered.row_index(wide, [], "at", "n", ranges, order), numbered)
        # ties broken by another column than the one the ranges know
        other = wide.withColumn("n", F.row_number().over(Window.orderBy("at", "v", "id")).cast("bigint"))
        assert same(ordered.row_index(wide, [], "at", "n", ranges, ["v", "id"]), other)


@pytest.mark.parametrize("accuracy", [1, 5, 16, 100, 1000, 10_000])
def test_quantiles(skewed, accuracy):
    wanted = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.9, "e": 1.0}
    got = ordered.exact_quantiles(skewed, ["entity"], "v", wanted, accuracy)
    exact = [F.round(F.percentile("v", F.lit(p)), 6).alias(n) for n, p in wanted.items()]
    expected = skewed.groupBy("entity").agg(*exact)
    assert same(got.select("entity", *[F.round(n, 6).alias(n) for n in wanted]), expected)


@pytest.mark.parametrize("accuracy", [20, 300])
def test_quantiles_with_narrow_windows(spark, accuracy):
    """Distinct, repeated and spread values, each in a group of its own and all together."""
    n = F.col("id")
    df = spark.range(0, 30_000, 1, 7).select(
        (n % 3).alias("g"), F.when(n % 3 == 0, n * 7919 % 30_011).when(n % 3 == 1, n % 4).otherwise(F.pow(F.lit(1.001), n)).alias("v")
    )
    wanted = {f"p{i}": i / 20 for i in range(21)}
    for by in (["g"], []):
        exact = df.groupBy(*by).agg(*[F.percentile("v", F.lit(p)).alias(k) for k, p in wanted.items()])
        got = ordered.exact_quantiles(df, by, "v", wanted, accuracy).select(*exact.columns)
        for mine, theirs in zip(sorted(got.collect()), sorted(exact.collect()), strict=True):
            assert tuple(mine) == pytest.approx(tuple(theirs), rel=1e-12)


def test_quantiles_keep_groups_without_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 2.0), ("b", None)], "g string, v double")
    got = ordered.exact_quantiles(df, ["g"], "v", {"p": 0.5}).collect()
    assert sorted(map(tuple, got)) == [("a", 1.5), ("b", None)]
    near = ordered.exact_quantiles(df, ["g"], "v", {"p": 0.5}, approx=True).collect()
    assert sorted(map(tuple, near)) == [("a", 1.0), ("b", None)]
    assert ordered.exact_quantiles(df.where("g = 'b'"), [], "v", {"p": 0.5}).collect()[0]["p"] is None


@pytest.mark.parametrize("parts", [1, 6])
def test_calendar_strict_over_ranges(spark, parts):
    """With ranges a series is cut as well, and the results stay those of plain windows."""
    n = F.col("id")
    day = F.date_add(F.lit("2020-01-01").cast("date"), (n + F.floor(n / 9) * 2).cast("int"))
    days = spark.range(400).select(
        day.alias("day"), (n % 2).alias("who"), (n % 7 != 3).alias("warm"), (n * 37 % 100).cast("double").alias("v")
    )
    ranges = ordered.balanced_ranges(days, "day", parts)
    runs = [
        series.consecutive_runs(days, "day", "warm", {"top": F.max("v")}, 1, ["who"], r, calendar_strict=True)
        for r in (None, ranges)
    ]
    assert same(*runs) and runs[0].count() > 20
    means = [series.rolling_mean(days, "day", "v", 3, "m", ["who"], r, calendar_strict=True) for r in (None, ranges)]
    assert same(*means)


@pytest.mark.parametrize("rows", [1, 2, 7, 40])
@pytest.mark.parametrize("parts", [1, 4, 30])
def test_rolling_means_over_ranges_shorter_than_the_window(spark, parts, rows):
    """An entity with a third of the rows, one with a single row, gaps, NULL orders and values."""
    df = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 17)).alias("who"),
        F.when(F.col("id") % 150 != 7, F.col("id") * 7919 % 4001).alias("at"),
        F.when(F.col("id") % 5 != 0, (F.col("id") * 31 % 97).cast("decimal(9,2)")).alias("v"),
        F.col("id").alias("tie"),
    )
    df = df.unionByName(spark.createDataFrame([("one", 5, 1, 9000)], "who string, at long, v long, tie long"))
    ranges = ordered.balanced_ranges(df, "at", parts)
    by_range, plain = (
        series.rolling_mean(df, "at", "v", rows, "m", ["who"], r, tiebreak=["tie"]) for r in (ranges, None)
    )
    assert same(by_range, plain)


def test_rolling_rows_are_shuffled_once(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("who"), F.col("id").alias("at"), F.rand(1).alias("v"), F.lit("w").alias("wide"))
    smooth = series.rolling_mean(df, "at", "v", 5, "m", ["who"], ordered.balanced_ranges(df, "at", 8))
    initial = smooth._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert initial.count("Union") == 1 and "WindowGroupLimit" in initial
    # The rows themselves pass one exchange, the one above the union.
    above, below = initial.split("Union", 1)
    assert above.count("Exchange") == 1
    own_rows = below.split("Range (")[0]
    assert "Exchange" not in own_rows


def test_slopes_do_not_depend_on_partitions(spark):
    """To the last bit, for doubles, decimals and missing values; against numpy."""
    n = F.col("id")
    df = spark.range(3000).select(
        (n % 3).alias("g"), F.timestamp_micros(n * 7_919_000_123 + 1_600_000_000_000_000).alias("at"),
        F.when(n % 11 != 0, F.pow(n % 97, F.lit(1.3)) * 1e6 + n / 7).alias("v"),
    )
    slope = lambda d: series._slope(F.unix_millis("at"), F.col("v").cast("decimal(18,6)"), 1e9)
    found = [
        d.groupBy("g").agg(slope(d).alias("s")).orderBy("g").collect()
        for d in (df.coalesce(1), df.repartition(7, "v"), df.orderBy(F.desc("v")).repartition(3))
    ]
    assert found[0] == found[1] == found[2]
    for g, s in found[0]:
        rows = df.where(F.col("g") == g).where("v is not null").select(F.unix_millis("at"), F.round("v", 6)).collect()
        x, y = np.array(rows, dtype=float).T
        x = x - x.mean()
        assert s == pytest.approx((x * (y - y.mean())).sum() / (x * x).sum() * 1e9, rel=1e-6)
    assert series.trend_per_year(df.limit(0), "v", "at").collect()[0][0] is None
    assert series.trend_per_year(df.limit(1), "v", "at").collect()[0][0] is None


def test_calendar_runs_against_numbering(spark):
    days = spark.range(900).select(
        F.date_add(F.lit("2019-12-20").cast("date"), (F.col("id") % 300 + F.col("id") % 300 / 13).cast("int")).alias("day"),
        F.floor(F.col("id") / 300).alias("who"), (F.col("id") * 7919 % 5 > 0).alias("warm"), (F.col("id") % 17).alias("v"),
    ).dropDuplicates(["day", "who"])
    peak = {"peak": F.max("v")}
    strict = series.consecutive_runs(days, "day", "warm", peak, 2, ["who"], calendar_strict=True)
    assert same(series.calendar_runs(days, "day", "warm", peak, 2, ["who"]), strict)
    plain = spark.createDataFrame(days.collect(), days.schema)
    plan = series.calendar_runs(plain, "day", "warm", peak, 2, ["who"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "MergingSessions" in plan.split("Exchange")[0]
    assert "HashAggregate" in plan.split("Exchange")[1]


def test_united_sketches_count_what_single_ones_would(spark):
    n = F.col("id")
    df = spark.range(60_000).select((n % 5).alias("site"), (n % 4).alias("yr"), F.when(n % 9 > 0, n * n % 20_011).alias("species"))
    sketches = panel.distinct_sketches(df, ["site", "yr"], "species")
    for by in (["site"], ["yr"], []):
        exact = df.groupBy(*by).agg(F.count_distinct("species").alias("n")).collect()
        near = {tuple(r[c] for c in by): r["n"] for r in panel.united_distinct(sketches, by, "n").collect()}
        assert all(abs(near[tuple(r[c] for c in by)] - r["n"]) <= 0.05 * r["n"] for r in exact)
    none = panel.distinct_sketches(df.where("species IS NULL"), ["site"], "species")
    assert none.collect() == []

"""A long synthetic record: the injected trend is found, faults and gaps are handled."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from obslake.operators import series
from obslake.operators.ordered import Ranges
from obslake.plans import monthly_temperature as plan
from tests.conftest import rows, same

TREND = 0.022


@pytest.fixture(scope="module")
def raw(spark):
    """82 years, four readings a month, one month missing, two faults, deep and unknown depths."""
    found = []
    for month in range(82 * 12):
        if month == 500:
            continue
        year, m = 1944 + month // 12, month % 12 + 1
        for k, depth in enumerate([0.0, 10.0, None, 50.0]):
            moment = dt.datetime(year, m, 1 + 7 * k, 12)
            season = 14 + 3 * math.cos(2 * math.pi * (m - 2) / 12)
            noise = ((month * 31 + k * 17) % 23 - 11) / 40
            found.append((moment, depth, season + TREND * month / 12 + noise - (5 if depth == 50.0 else 0)))
    found += [(dt.datetime(1990, 5, 3), 0.0, 99.0), (dt.datetime(1991, 5, 3), 0.0, -3.0)]
    return spark.createDataFrame(found, "TIME timestamp, DEPTH double, TEMP double").cache()


@pytest.fixture(scope="module")
def fact(raw):
    return plan.monthly_series(plan.observations(raw), "url").cache()


def test_names_are_resolved(raw):
    renamed = raw.withColumnsRenamed({"TIME": "time", "TEMP": "sea_water_temperature"}).drop("DEPTH")
    obs = plan.observations(renamed)
    assert obs.columns == ["time", "temp_c", "depth_m"]
    assert obs.where("depth_m is not null").isEmpty()
    with pytest.raises(KeyError):
        plan.observations(raw.drop("TEMP"))


def test_filter_counts(raw):
    n = raw.count()
    assert rows(plan.filter_counts(plan.observations(raw))) == [(n, n - 983 - 2)]


def test_series(fact):
    assert fact.count() == 983
    assert dict(fact.dtypes)["temp_c"] == "decimal(5,2)"
    assert plan.constraints(fact).where("violations > 0").isEmpty()
    assert fact.select("depth_bin").distinct().first()[0] == "surface_lt_10m"


def test_trend_is_recovered(fact):
    slope = plan.warming_trend(fact).first()[0]
    assert abs(slope - TREND) < 0.001
    summary = plan.run_summary(fact).first()
    assert summary["n_rows"] == 983 and abs(summary["per_year"] - TREND) < 0.001
    assert summary["n_warm"] == fact.where("is_warm_month").count()
    short = series.trend_if_enough(fact.limit(24), "temp_c", "month_date").first()
    assert short["per_year"] is None


def test_warm_flag_uses_unrounded_values(spark):
    """Ten equal months and one a hair above: rounding first would lose the warm month."""
    days = [(dt.datetime(1990 + i, 6, 1), 10.0 + (0.004 if i == 11 else 0.0)) for i in range(12)]
    obs = spark.createDataFrame(days, "time timestamp, temp_c double").withColumn("depth_m", F.lit(None).cast("double"))
    warm = plan.monthly_series(obs, "u").where("is_warm_month")
    assert [(r["month_date"].year, float(r["temp_c"])) for r in warm.collect()] == [(2001, 10.0)]


def test_rolling_counts_rows(fact):
    got = plan.rolling_year(fact).orderBy("month_date").collect()
    temps = [float(r["temp_c"]) for r in got]
    for i in (0, 5, 11, 505, 982):
        window = temps[max(0, i - 11) : i + 1]
        assert abs(got[i]["rolling_12mo_avg_c"] - sum(window) / len(window)) <= 0.0051


def test_spells_are_runs_of_flagged_rows(fact):
    every = series.consecutive_runs(fact, "month_date", "is_warm_month", {}, 1)
    assert every.agg(F.sum("n_rows")).first()[0] == fact.where("is_warm_month").count()
    long = plan.warm_spells(fact)
    assert long.count() == every.where("n_rows >= 3").count() > 0
    flags = [(r["month_date"], r["is_warm_month"]) for r in fact.orderBy("month_date").collect()]
    for run in every.collect():
        inside = [f for m, f in flags if run["run_start"] <= m <= run["run_end"]]
        assert all(inside) and len(inside) == run["n_rows"]


def test_decades_and_dashboard(fact):
    assert rows(plan.months_by_decade(fact))[0] == (1940, 72)
    tables = plan.dashboard(fact)
    assert tables["coverage"].first()["n_months"] == 983


def test_a_gap_ends_a_run_only_by_calendar(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3, 5, 6)]
    df = spark.createDataFrame([(d, True) for d in days], "day date, warm boolean")
    assert series.consecutive_runs(df, "day", "warm", {}, 1).count() == 1
    strict = series.consecutive_runs(df, "day", "warm", {}, 1, calendar_strict=True)
    assert rows(strict.select("n_rows")) == [(2,), (3,)]


@pytest.mark.parametrize("edges", [(), (0.0, 5.0), (10957.0,)])
def test_ranges_change_nothing(fact, edges):
    ranges = Ranges(edges)

    def runs(r):
        measures = {"peak": F.max("temp_c")}
        return series.consecutive_runs(fact, "month_date", "is_warm_month", measures, 2, ranges=r)

    assert same(runs(ranges), runs(None))
    kept = fact.select("month_date", "temp_c")
    rolled = [series.rolling_mean(kept, "month_date", "temp_c", 12, "r", ranges=r) for r in (ranges, None)]
    assert same(*rolled)
    changed = [series.period_change(kept, "month_date", "temp_c", ranges=r) for r in (ranges, None)]
    assert same(*changed)

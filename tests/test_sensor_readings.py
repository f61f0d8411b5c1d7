"""Raw sensor text to flags, climatology, runs and the gate, against a direct count."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from obslake.operators import keys, quality
from obslake.operators.ordered import Ranges
from obslake.plans import sensor_readings as plan
from obslake.schemas import SENSOR_HEADER
from obslake.session import new_path
from obslake.sources import tables
from obslake.sources.delimited import text_schema
from tests.conftest import rows, same

START = dt.datetime(2020, 1, 1)


def reading(code, depth, moment, temp, qc="1", psal="35.1"):
    values = dict.fromkeys(SENSOR_HEADER, "")
    values |= {
        "site_code": "S", "deployment_code": code, "instrument_nominal_depth": depth,
        "TIME": moment.strftime("%Y-%m-%dT%H:%M:%SZ"), "LATITUDE": "-42.5", "LONGITUDE": "148.2",
        "DEPTH": "20.1", "DEPTH_quality_control": "1", "TEMP": temp, "TEMP_quality_control": qc,
        "PSAL": psal, "PSAL_quality_control": "1",
    }
    return tuple(values[c] for c in SENSOR_HEADER)


@pytest.fixture(scope="module")
def staged(spark):
    """Two deployments of two instruments, hourly for 40 days, with every oddity."""
    found = []
    for d, code in enumerate(("D1", "D2")):
        for depth, base in (("20.0", 16.0), ("85.0", 13.0)):
            for h in range(40 * 24):
                moment = START + dt.timedelta(days=400 * d, hours=h)
                temp = base + (h // 24 % 7) * 0.3 + (4.5 if h == 500 else 0) + (h % 5) * 0.01
                qc = "4" if h % 50 == 7 else "2" if h % 3 == 0 else "1"
                if depth == "85.0" and 240 <= h < 264:
                    continue  # a day seen at one depth only
                found.append(reading(code, depth, moment, f"{temp:.3f}", qc))
    found.append(found[100])  # an exact copy
    found.append(reading("D1", "20.0", START + dt.timedelta(hours=2, minutes=5), "55.0"))
    found.append(reading("D1", "20.0", START + dt.timedelta(hours=2, minutes=6), "12.0", psal=""))
    return spark.createDataFrame(found, text_schema(SENSOR_HEADER)).cache()


@pytest.fixture(scope="module")
def clean(staged):
    return plan.clean_readings(staged).cache()


@pytest.fixture(scope="module")
def dim(spark, clean):
    path = new_path(spark, "dim")
    tables.replace_table(plan.deployments(clean), path)
    return tables.read_table(spark, path)


@pytest.fixture(scope="module")
def fact(clean, dim):
    return plan.readings(clean, dim).cache()


@pytest.fixture(scope="module")
def flags(fact, dim):
    return plan.reading_flags(fact, dim).cache()


def test_clean(staged, clean):
    assert clean.count() == staged.count() - 3
    assert dict(clean.dtypes)["nominal_depth_m"] == "decimal(5,1)"
    with pytest.raises(ValueError, match="TEMP"):
        plan.clean_readings(staged.drop("TEMP"))
    summary = plan.clean_summary(staged, clean).first()
    assert (summary["n_before"], summary["n_plausible"], summary["n_clean"]) == (
        staged.count(), staged.count() - 2, staged.count() - 3,
    )
    assert (summary["n_deployments"], summary["n_depths"]) == (2, 2)


def test_star_schema(fact, dim, clean):
    assert rows(dim.select("deployment_id", "deployment_code", "nominal_depth_m"))[0][0:2] == (1, "D1")
    assert dim.count() == 4 and fact.count() == clean.count()
    assert plan.constraints(fact, dim).where("violations > 0").isEmpty()
    assert same(keys.require_resolved(fact, "deployment_id"), fact)
    orphaned = plan.readings(clean, dim.where("deployment_id < 4"))
    with pytest.raises(PySparkException, match="deployment_id"):
        keys.require_resolved(orphaned, "deployment_id").collect()
    report = plan.constraints(orphaned, dim)
    assert report.where("rule = 'deployment present'").first()["violations"] > 0


def test_flags(flags, fact, dim):
    spans = {r["deployment_id"]: r for r in dim.collect()}
    series = defaultdict(list)
    for r in fact.where("temp_qc in (1, 2)").collect():
        series[r["deployment_id"]].append((r["timestamp"], r["temp_c"]))
    expected = []
    margin = dt.timedelta(hours=6)
    for entity, readings in series.items():
        readings.sort()
        for (moment, temp), before in zip(readings, [None, *readings]):
            delta = None if before is None else temp - before[1]
            edge = (
                moment <= spans[entity]["deployment_start"] + margin
                or moment >= spans[entity]["deployment_end"] - margin
            )
            expected.append((entity, moment, delta, None if delta is None else abs(delta) > 3, edge))
    got = flags.select("deployment_id", "timestamp", "delta_c", "flag_spike", "flag_boundary")
    assert rows(got) == sorted(expected, key=repr)


def test_ranges_change_no_flag(fact, dim, flags):
    for edges in ((), (1.58e15,), (1.5795e15, 1.58e15, 1.6e15)):
        assert same(plan.reading_flags(fact, dim, ranges=Ranges(edges)), flags)


def test_flag_counts(flags):
    counted = plan.flag_counts(flags).first()
    assert counted["n_spike_flagged"] == 8  # up and down, four instruments
    assert counted["total_good_or_probable_qc"] == flags.count()


def test_daily_and_stratification(flags):
    daily = plan.daily_analysis(flags).cache()
    # The first good reading of a deployment has no step and never reaches a mean.
    kept = flags.where(~F.col("flag_spike") & ~F.col("flag_boundary"))
    assert kept.where("delta_c is null").isEmpty()
    assert daily.select("nominal_depth_m", "day").distinct().count() == daily.count()
    layers = plan.stratification(daily, 20, 85)
    missing = {START.date() + dt.timedelta(days=10 + 400 * d) for d in (0, 1)}
    assert not missing & {r["day"] for r in layers.collect()}
    assert layers.count() == daily.where("nominal_depth_m = 85").count()
    assert all(abs(r["stratification_c"] - 3) < 0.2 for r in layers.collect())
    spells = plan.warm_spells(daily)
    assert spells.where("n_days < 3").isEmpty()
    years = plan.year_temperatures(daily, 20)
    assert rows(years.select("yr")) == [(2020,), (2021,)]
    last = plan.latest_by_depth(daily, [20, 85])[20].first()
    assert last["day"] == daily.where("nominal_depth_m = 20").agg(F.max("day")).first()[0]


def test_trend_and_coverage(fact, dim):
    assert plan.trend_by_depth(fact, dim).count() == 2
    empty = dim.unionByName(dim.limit(1).withColumn("deployment_id", F.lit(99).cast("bigint")))
    counts = dict(rows(plan.readings_per_deployment(fact, empty).select("deployment_id", "n_readings")))
    assert counts[99] == 0 and sum(counts.values()) == fact.count()


def audit(spark, source, loaded):
    log = spark.createDataFrame(
        [(source, source - loaded, dt.datetime(2024, 1, 1)), (10, 10, dt.datetime(2023, 1, 1))],
        "rows_source long, rows_rejected long, finished_at timestamp",
    )
    return log


def test_gate(spark, fact, dim):
    as_of = dt.datetime(2021, 3, 20)
    clean_gate = plan.gate(fact, dim, audit(spark, 100, 99), as_of)
    assert quality.gate_passed(clean_gate)
    assert rows(clean_gate.where("not ok")) == []
    wrong = fact.limit(1).withColumn("temp_c", F.lit(31).cast("decimal(5,2)"))
    strays = [fact.limit(1).withColumn("deployment_id", F.lit(d).cast("bigint")) for d in (77, None)]
    bad = fact.unionByName(wrong).unionByName(strays[0]).unionByName(strays[1])
    gate = plan.gate(bad, dim, audit(spark, 100, 50), dt.datetime(2024, 1, 1))
    broken = {r["check"]: r["observed"] for r in gate.where("not ok").collect()}
    assert not quality.gate_passed(gate)
    assert broken["duplicate_keys"] == 1 and broken["out_of_range"] == 1 and broken["orphans"] == 2
    assert broken["age_days"] > 14 and broken["rejected_pct"] == 50
    noisy = fact.withColumn("temp_qc", F.when(F.col("deployment_id") == 1, 4).otherwise(F.col("temp_qc")).cast("smallint"))
    warned = plan.gate(noisy, dim, audit(spark, 100, 100), as_of).where("check = 'bad_pct'")
    assert rows(warned.select("tier", "subject", "observed", "ok")) == [("WARN", "D1 @ 20.0", 100.0, False)]


def test_gate_without_loads_on_record(spark, fact, dim):
    gate = plan.gate(fact, dim, audit(spark, 1, 1).where("false"), dt.datetime(2021, 3, 20))
    assert rows(gate.where("not ok").select("check", "tier")) == [("rejected_pct", "WARN")]
    assert quality.gate_passed(gate)


def test_load_twice_and_with_a_new_deployment(spark, staged, clean):
    folder, now = new_path(spark, "warehouse"), dt.datetime(2024, 1, 1)
    first = staged.where("deployment_code = 'D1'")
    for export in (first, first, staged):
        paths = plan.load(export, folder, "export.csv", now, now)
    dim, fact, log = (tables.read_table(spark, p) for p in paths.values())
    assert fact.count() == clean.count()
    assert plan.constraints(fact, dim).where("violations > 0").isEmpty()
    assert rows(dim.select("deployment_id", "deployment_code")) == [(1, "D1"), (2, "D1"), (3, "D2"), (4, "D2")]
    assert [r["load_id"] for r in log.orderBy("load_id").collect()] == [1, 2, 3]
    last = log.where("load_id = 3").first()
    assert (last["rows_source"], last["rows_loaded"], last["rows_rejected"]) == (staged.count(), clean.count(), 3)

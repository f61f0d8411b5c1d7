"""Spread, panels, lags and trends of surveyed species on a hand-made survey."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from obslake.operators import panel, stats
from obslake.plans import species_survey as plan
from obslake.schemas import SURVEY_HEADERS
from obslake.session import new_path
from obslake.sources import tables
from obslake.sources.delimited import text_schema
from tests.conftest import rows

SPIKY, PURPLE, CRAY = "Spiky urchin", "Purple urchin", "Crayfish"


def survey_row(kind, i, **values):
    filled = dict.fromkeys(SURVEY_HEADERS[kind])
    filled |= {
        "fid": f"{kind}.{i}", "survey_id": str(i), "area": "Home", "site_code": "A", "latitude": "-42.0",
        "longitude": "148.0", "survey_date": "2010-02-03", "species_name": SPIKY, "total": "1",
    }
    filled |= {k: None if v is None else str(v) for k, v in values.items()}
    return tuple(filled[c] for c in SURVEY_HEADERS[kind])


def frame(spark, kind, records):
    data = [survey_row(kind, i, **r) for i, r in enumerate(records)]
    return spark.createDataFrame(data, text_schema(SURVEY_HEADERS[kind]))


def clean(spark, kind, records):
    return plan.clean_rows(plan.typed_rows(frame(spark, kind, records)), kind, "Home")


def on(year):
    return f"{year}-02-03"


@pytest.fixture(scope="module")
def animals(spark):
    return clean(
        spark,
        "invertebrate",
        [
            # Site A is surveyed before the species turns up; a zero count is no sighting.
            dict(survey_date=on(2008), species_name=PURPLE, total=4),
            dict(survey_date=on(2009), total=0),
            dict(survey_date=on(2010), total=3, latitude=-42.1),
            dict(survey_date=on(2010), total=2, latitude=-42.2, longitude=147.9),
            dict(survey_date=on(2010), species_name=CRAY, total=12),
            # The year 2011 is not surveyed: the previous row of 2012 is 2010.
            dict(survey_date=on(2012), total=7, latitude=-42.1),
            dict(survey_date=on(2012), species_name=CRAY, total=1),
            # Site B is first surveyed in the year of its first sighting.
            dict(site_code="B", survey_date=on(2012), total=1, latitude=-43.0),
            dict(site_code="B", survey_date=on(2013), species_name=CRAY, total=2),
            # Site C never sees it.
            dict(site_code="C", survey_date=on(2012), species_name="Haliotis rubra", total=9),
        ],
    ).cache()


@pytest.fixture(scope="module")
def cover(spark):
    return clean(
        spark,
        "benthic",
        [
            dict(survey_date=on(2010), habitat_groups="Canopy", total=40),
            dict(survey_date=on(2010), habitat_groups="Canopy", total=50),
            dict(survey_date=on(2010), habitat_groups="Sand", total=100),
            dict(survey_date=on(2012), habitat_groups="Sand", total=100),
            dict(site_code="B", survey_date=on(2014), habitat_groups="Canopy", total=10),
        ],
    ).cache()


@pytest.fixture(scope="module")
def fish(spark):
    return clean(
        spark,
        "fish",
        [
            dict(survey_date=on(2010), species_name="Perch", total=5, biomass=10.5),
            dict(survey_date=on(2010), species_name="Perch", total=2, biomass=1.5),
            dict(survey_date=on(2010), species_name="Wrasse", total=1),
            dict(site_code="B", survey_date=on(2015), species_name="Wrasse", total=1, biomass=2),
        ],
    ).cache()


def test_cleaning(spark):
    records = [
        dict(), dict(area="Away"), dict(latitude=None), dict(total=-1), dict(total=None),
        dict(biomass=-0.5), dict(biomass=0), dict(site_code=None), dict(species_name=None), dict(hour=""),
    ]
    typed = plan.typed_rows(frame(spark, "fish", records))
    assert typed.count() == 8
    assert typed.where("hour is not null").isEmpty()
    kept = plan.clean_rows(typed, "fish", "Home")
    assert sorted(int(r["survey_id"]) for r in kept.collect()) == [0, 6, 9]
    assert dict(kept.dtypes)["survey_date"] == "date" and "geom" not in kept.columns
    assert "quadrat" in clean(spark, "benthic", [dict()]).columns


def test_loading_twice_adds_nothing(spark):
    raw = plan.typed_rows(frame(spark, "fish", [dict(), dict(total=3), dict(area="Away")]))
    path = new_path(spark, "fish")
    for part in (raw.limit(1), raw, raw.union(raw)):
        plan.load(part, "fish", "Home", path)
    loaded = tables.read_table(spark, path)
    assert loaded.count() == 2
    assert plan.constraints(loaded, raw, "fish").where("violations > 0").isEmpty()
    stray = plan.constraints(loaded.withColumn("fid", F.lit("x")), raw, "fish").where("violations > 0")
    assert rows(stray) == [("fid known", 2), ("one row per fid", 1)]


def test_first_detection(animals):
    # The least latitude and longitude come from different sightings.
    assert rows(plan.first_detection(animals, SPIKY)) == [
        ("A", -42.2, 147.9, 2010, False), ("B", -43.0, 148.0, 2012, True),
    ]


def test_spread(animals):
    assert rows(plan.sites_by_year(animals, SPIKY)) == [(2010, 1), (2012, 2)]
    assert rows(plan.range_edge(animals, SPIKY)) == [(2010, -42.2), (2012, -43.0)]
    seen = plan.sightings(animals, SPIKY)
    assert seen.where("yr = 2010").count() == 2
    years = animals.sparkSession.createDataFrame([(2012,), (2011,)], "yr int")
    assert rows(plan.site_names_by_year(seen, years)) == [(2011, 0, ""), (2012, 0, "A, B")]


def test_large_id_groups_come_in_parts(animals):
    seen = plan.sightings(animals, SPIKY)
    parts = stats.ids_by_group(seen, "yr", "site_code", ids_per_part=1)
    assert sorted(rows(parts)) == [(2010, 0, "A"), (2010, 1, "A"), (2012, 0, "A"), (2012, 1, "B")]


def test_id_parts_are_full_and_in_order(spark):
    ids = [(g, f"id{(i * 37) % 50:02d}") for g in ("x", "y", None) for i in range(83)] + [("x", "hot")] * 40
    df = spark.createDataFrame(ids, "g string, i string").repartition(5)
    got = {(r["g"], r["part"]): r["ids"].split(", ") for r in stats.ids_by_group(df, "g", "i", ids_per_part=10).collect()}
    for group in ("x", "y", None):
        wanted = sorted(i for g, i in ids if g == group)
        parts = [got[group, p] for p in range(-(-len(wanted) // 10))]
        assert [len(p) for p in parts[:-1]] == [10] * (len(parts) - 1)
        assert sum(parts, []) == wanted


def test_yearly_trend_needs_both_sides(spark, animals, cover):
    sites = panel.site_list(spark, ["A", "C"], "site_code")
    trend = plan.yearly_trend(
        animals, cover, sites, {"spiky": SPIKY, "cray": CRAY}, {"abalone": "Haliotis"}
    )
    assert [tuple(map(float, r[1:4])) + (r[0], r[4]) for r in trend.orderBy("yr").collect()] == [
        (5.0, 12.0, 0.0, 2010, 45.0), (7.0, 1.0, 9.0, 2012, None),
    ]


def test_panel_keeps_every_site_year(spark, animals, cover, fish):
    sites = panel.site_list(spark, ["A", "B"], "site_code")
    got = plan.site_year_panel(animals, cover, fish, sites, SPIKY, PURPLE)
    by = {(r["site_code"], r["yr"]): r for r in got.collect()}
    assert set(by) == {
        ("A", 2008), ("A", 2009), ("A", 2010), ("A", 2012), ("B", 2012), ("B", 2013), ("B", 2014), ("B", 2015),
    }
    full = by["A", 2010]
    assert (full["invasive_urchin_count"], full["native_urchin_count"], full["canopy_pct"]) == (5, 0, 45.0)
    assert (full["fish_richness"], full["fish_biomass"], full["fish_count"]) == (2, 12, 8)
    lone = by["B", 2014]
    assert (lone["invasive_urchin_count"], lone["canopy_pct"], lone["fish_richness"]) == (0, 10.0, None)
    picked = plan.richness_slice(got, ["A"], 2009, 2011)
    assert [(r["yr"], r["marker_size"]) for r in picked.collect()] == [(2010, 28.0)]
    assert plan.canopy_correlations(got).first()["corr_richness"] is None  # one pair only


def test_lag_means_previous_surveyed_year(animals):
    lagged = plan.predator_lag(animals, CRAY, SPIKY)
    got = {(r["site_code"], r["yr"]): r["lobster_prev_year"] for r in lagged.collect()}
    assert got["A", 2012] == 12 and got["A", 2010] == 0 and got["A", 2008] is None
    tiers = {(r["site_code"], r["yr"]): r["lobster_tier"] for r in plan.lag_tiers(lagged).collect()}
    assert tiers == {("A", 2009): "none", ("A", 2010): "none", ("A", 2012): "high", ("B", 2013): "none"}
    report = plan.lag_report(lagged)
    assert [(r["lobster_tier"], r["mean_value"]) for r in report["means"].orderBy("tier_no").collect()] == [
        ("none", pytest.approx(5 / 3)), ("low", None), ("medium", None), ("high", 7.0),
    ]
    box = {r["lobster_tier"]: r for r in report["boxes"].collect()}["none"]
    assert (box["low"], box["q1"], box["median"], box["q3"], box["high"]) == (0.0, 0.0, 0.0, 2.5, 5.0)
    assert report["correlation"].first()["corr_lag"] == pytest.approx(48 / (108 * 38) ** 0.5)


def test_trends_need_support(spark):
    records = [dict(species_name="Ten", survey_date=on(2000 + i), total=3 * i + 1) for i in range(10)]
    records += [dict(species_name="Nine", survey_date=on(2000 + i), total=i) for i in range(9)]
    records += [dict(species_name="Down", survey_date=on(2000 + 2 * i), total=50 - i) for i in range(12)]
    fish = clean(spark, "fish", records)
    trends = plan.species_trends(fish)
    got = {r["species_name"]: r for r in trends.collect()}
    assert set(got) == {"Ten", "Down"}
    assert got["Ten"]["trend_per_year"] == pytest.approx(3)
    assert (got["Ten"]["first_year"], got["Ten"]["last_year"]) == (2000, 2009)
    assert (got["Ten"]["first_count"], got["Ten"]["last_count"]) == (1, 28)
    assert got["Down"]["trend_per_year"] == pytest.approx(-0.5)
    assert plan.species_series(fish).count() == 22
    names = spark.createDataFrame([("Ten", "Tenner")], "species_name string, common_name string")
    ends = plan.risers_and_fallers(trends, names, 2)
    assert rows(ends.select("label")) == [("Down",), ("Tenner (Ten)",)]
    one = plan.risers_and_fallers(trends, names, 1)
    assert one.count() == 2
    dense = panel.densify_years(plan.fish_by_year(fish).where("species_name = 'Down'"), "yr", ["species_name"])
    assert dense.count() == 23 and dense.where("total_count is null").count() == 11


def test_series_ending_on_a_tie_is_whole(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 6.0), ("b", 5.0, 5.0)], "s string, x double, y double")
    own = stats.indexed(df, "x", "i", ["s"])
    assert rows(own.select("s", "x", "i")) == [("a", 1.0, 0.0), ("a", 3.0, 100.0), ("b", 5.0, 0.0)]
    joint = stats.indexed_jointly(df, {"x": "xi", "y": "yi"})
    assert rows(joint.select("xi", "yi")) == [(0.0, 20.0), (40.0, 100.0), (80.0, 80.0)]
    assert rows(stats.axis_range(df, ["x", "y"], 0.5)) == [(0.5, 6.5)]


def test_latest_rows_put_missing_times_first(spark):
    moments = [None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2)]
    df = spark.createDataFrame(list(enumerate(moments)), "id int, ts timestamp")
    assert [r["id"] for r in stats.latest_rows(df, "ts", 3, [F.col("id")]).collect()] == [0, 2, 3]
    assert rows(stats.latest_per_entity(df, [], "ts", ["id"]).select("id")) == [(3,)]


def test_correlation_of_constant_or_single_pairs_is_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (None, 9.0, 5.0)], "a double, b double, c double")
    got = stats.correlations(df, {"ab": ("a", "b"), "ac": ("a", "c")}).first()
    assert got["ab"] == pytest.approx(1.0) and got["ac"] is None
    assert stats.correlations(df.limit(1), {"ab": ("a", "b")}).first()["ab"] is None

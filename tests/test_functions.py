from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obslake.functions import calendar, numbers, text
from obslake.sources.html_tables import clean_cell


def values(spark, column, inputs, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_to_number(spark):
    cases = {
        "393..07": 393.07, "1,023,187.30": 1023187.3, "": None, "  ": None, None: None,
        "-5.": -5.0, ".5": 0.5, ".": None, "n/a": None, "5d": None, "nan": None, "inf": None,
        "1e3": 1000.0, "1_000": 1000.0, "_1": None, " 42 ": 42.0, "+7": 7.0, "1...2": 1.2,
    }
    assert values(spark, text.to_number(F.col("v")), list(cases)) == list(cases.values())


def test_repeated_dots(spark):
    assert values(spark, text.has_repeated_dots(F.col("v")), ["1..2", "1.2", "", None]) == [
        True, False, False, False,
    ]


def test_month_start(spark):
    cases = {
        "March 2007": dt.date(2007, 3, 1), "MAY  2010 x": dt.date(2010, 5, 1), "x May 2010": None,
        "Foo 2010": None, "May 20": None, "": None, None: None, "December 20199": dt.date(2019, 12, 1),
    }
    assert values(spark, text.month_start(F.col("v")), list(cases)) == list(cases.values())


def test_clean_text_agrees_with_the_cell_cleaner(spark):
    samples = ["​​**a**  b\t\nc ", "ﬁne x", "½ ＡＢ", "", "*", "　x y", "a\x1cb"]
    assert values(spark, text.clean_text(F.col("v")), samples) == [clean_cell(s) for s in samples]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=20, max_size=20))
def test_clean_text_on_any_text(spark, samples):
    # Lone surrogates cannot be stored; letter case and order never change.
    samples = [s.encode("utf-8", "ignore").decode() for s in samples]
    assert values(spark, text.clean_text(F.col("v")), samples) == [clean_cell(s) for s in samples]


def test_units_and_labels(spark):
    got = values(spark, text.kilograms_to_tonnes(F.lit(80052.7), F.col("v")), ["KG", "tonnes", None])
    assert got == [80.0527, 80052.7, 80052.7]
    got = values(spark, text.display_label(F.lit("Aa bb"), F.col("v")), ["Perch", None])
    assert got == ["Perch (Aa bb)", "Aa bb"]
    assert values(spark, text.is_true_text(F.col("v")), ["True", "TRUE", "false", "", None]) == [
        True, True, False, False, False,
    ]
    assert values(spark, text.blank_to_null(F.col("v")), ["", "a", None]) == [None, "a", None]


def test_rounding_regimes(spark):
    doubles = [0.125, 2.5, 1.005, -0.125, None]
    half_up = values(spark, numbers.half_up(F.col("v"), 2), doubles, "v double")
    half_even = values(spark, numbers.half_even(F.col("v"), 2), doubles, "v double")
    assert half_up == [0.13, 2.5, 1.01, -0.13, None]
    assert half_even == [0.12, 2.5, 1.0, -0.12, None]


def test_tiers_are_right_closed(spark):
    tier = numbers.ordered_tier(F.col("v"), [0, 3, 9], ["none", "low", "medium", "high"])
    got = values(spark, tier, [0.0, 1.0, 3.0, 3.5, 9.0, 10.0, None], "v double")
    assert got == ["none", "low", "low", "medium", "medium", "high", None]
    with pytest.raises(ValueError):
        numbers.ordered_tier(F.col("v"), [0], ["none"])


def test_sizes_and_indices(spark):
    size = numbers.area_size(F.col("v"), F.lit(16.0), 14, 34, 8)
    assert values(spark, size, [16.0, 4.0, 0.0, -1.0], "v double") == [48.0, 31.0, 14.0, 14.0]
    assert values(spark, numbers.area_size(F.col("v"), F.lit(0.0), 6, 22, 8), [0.0], "v double") == [8.0]
    index = numbers.min_max_index(F.col("v"), F.lit(2.0), F.lit(6.0))
    assert values(spark, index, [2.0, 4.0, 6.0, None], "v double") == [0.0, 50.0, 100.0, None]
    assert values(spark, numbers.min_max_index(F.col("v"), F.lit(2.0), F.lit(2.0)), [2.0], "v double") == [0.0]
    assert values(spark, numbers.sign_class(F.col("v")), [0.0, -1.0, None], "v double") == [
        "positive", "negative", None,
    ]
    assert values(spark, numbers.percent(F.col("v"), F.lit(0)), [1.0], "v double") == [None]


def test_calendar(spark):
    moments = [dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 1, 6, 0, 1), dt.datetime(2024, 1, 9, 23)]
    start, end = F.lit("2024-01-01 00:00:00").cast("timestamp"), F.lit("2024-01-10 05:00:00").cast("timestamp")
    edge = calendar.near_edge(F.col("v"), start, end, "6 hours")
    assert values(spark, edge, moments, "v timestamp") == [True, False, True]
    days = calendar.whole_days(F.col("v"), end)
    assert values(spark, days, moments, "v timestamp") == [8, 8, 0]
    years = values(spark, calendar.epoch_years(F.col("v")), [dt.datetime(1971, 1, 1)], "v timestamp")
    assert math.isclose(years[0], 365 / 365.25)
    assert values(spark, calendar.decade_of(F.col("v")), [1999, 2000], "v int") == [1990, 2000]

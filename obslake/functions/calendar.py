"""Calendar keys and spans as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365.25
SECONDS_PER_YEAR = DAYS_PER_YEAR * 24 * 3600


def epoch_seconds(moment: Column) -> Column:
    """Seconds since 1970 with fractions. Timestamps without zone are read as UTC."""
    return F.unix_micros(moment.cast("timestamp")) / F.lit(1000000.0)


def epoch_years(moment: Column) -> Column:
    """Time in years of 365.25 days since 1970, the x axis of every trend."""
    return epoch_seconds(moment) / F.lit(SECONDS_PER_YEAR)


def year_of(moment: Column) -> Column:
    return F.year(moment)


def day_of(moment: Column) -> Column:
    return F.to_date(moment)


def month_of(moment: Column) -> Column:
    return F.to_date(F.trunc(moment, "month"))


def near_edge(moment: Column, start: Column, end: Column, margin: str) -> Column:
    """True within ``margin`` (an interval such as ``6 hours``) of either end."""
    gap = F.expr(f"INTERVAL {margin}")
    return (moment <= start + gap) | (moment >= end - gap)


def span_years(earliest: Column, latest: Column) -> Column:
    """Whole days between two moments, in years."""
    return whole_days(earliest, latest) / F.lit(DAYS_PER_YEAR)


def whole_days(earlier: Column, later: Column) -> Column:
    """Completed 24-hour days from earlier to later."""
    return F.floor((epoch_seconds(later) - epoch_seconds(earlier)) / 86400).cast("bigint")


def decade_of(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")

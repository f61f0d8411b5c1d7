"""Rounding, percentages, scaling and binning as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, digits: int) -> Column:
    """Round as SQL NUMERIC does. Going through decimal keeps ties exact."""
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")


def half_even(value: Column, digits: int) -> Column:
    """Round ties to the even neighbour, as data-frame libraries do."""
    return F.bround(value.cast("decimal(28,10)"), digits).cast("double")


def mean(total: Column, count: Column) -> Column:
    """Exact decimal total over count, in double."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole; NULL for a zero whole."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def sign_class(value: Column) -> Column:
    """Zero counts as positive; a missing value has no class."""
    return F.when(value >= 0, "positive").when(value < 0, "negative")


def ordered_tier(value: Column, tops: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins: a value equal to a top belongs to that bin.

    ``labels`` is one longer than ``tops``; the last bin is open-ended.
    """
    if len(labels) != len(tops) + 1:
        raise ValueError("one label per top and one for the open-ended bin")
    tier = F.when(value <= tops[0], labels[0])
    for top, label in zip(tops[1:], labels[1:]):
        tier = tier.when(value <= top, label)
    return tier.when(value > tops[-1], labels[-1])


def area_size(value: Column, largest: Column, floor: float, span: float, empty: float) -> Column:
    """Square-root scaling so that marker area is proportional to the value."""
    root = F.sqrt(F.greatest(value.cast("double"), F.lit(0.0)))
    top = F.sqrt(F.greatest(largest.cast("double"), F.lit(0.0)))
    return F.when(top > 0, root / top * span + floor).otherwise(F.lit(float(empty)))


def min_max_index(value: Column, low: Column, high: Column) -> Column:
    """Position of value between low and high on a 0-100 scale; a flat range gives 0."""
    span = high - low
    scaled = (value - low) / span * 100
    return F.when(value.isNull(), F.lit(None)).when(span > 0, scaled).otherwise(F.lit(0.0))

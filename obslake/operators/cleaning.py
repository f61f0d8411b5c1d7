"""Row-level cleaning: plausibility, required keys, rejects, structural filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plausible(bounds: Mapping[str, tuple[float, float]]) -> Column:
    """Every value within its inclusive bounds; a missing value is not plausible."""
    return reduce(and_, [F.col(c).between(low, high) for c, (low, high) in bounds.items()])


def shallow(depth: str, limit: float) -> Column:
    """At or above the depth limit; readings without a depth count as surface."""
    return F.coalesce(F.col(depth), F.lit(0.0)) <= limit


def split_rejects(df: DataFrame, parsed: str) -> tuple[DataFrame, DataFrame]:
    """Rows where ``parsed`` worked, and the rows where it did not."""
    return df.where(F.col(parsed).isNotNull()), df.where(F.col(parsed).isNull())


def mark_parsed(df: DataFrame, parsed: str, out: str) -> DataFrame:
    """Say of each row whether ``parsed`` worked, without splitting and parsing twice."""
    return df.withColumn(out, F.col(parsed).isNotNull())


def with_required(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Drop rows lacking any required key."""
    return df.dropna(how="any", subset=list(required))


def dropped_for_keys(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """How many rows there are, and how many ``with_required`` drops."""
    lacking = reduce(or_, [F.col(c).isNull() for c in required])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(lacking).alias("n_dropped"))


def structurally_sound(
    region: tuple[str, str],
    present: Sequence[str],
    non_negative: Sequence[str],
    optional_non_negative: Sequence[str] = (),
) -> Column:
    """Right region, coordinates present, measures not negative.

    An optional measure may be missing but not negative.
    """
    column, name = region
    rules = [F.col(column) == name, *[F.col(c).isNotNull() for c in present]]
    rules += [F.col(c) >= 0 for c in non_negative]
    rules += [F.col(c).isNull() | (F.col(c) >= 0) for c in optional_non_negative]
    return reduce(and_, rules)


def select_renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep only the mapped columns, under their new names."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def with_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Provenance columns with one value for all rows."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def typed(df: DataFrame, casts: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Cast text columns: new name -> (text column, type). Blank becomes NULL.

    Text that does not fit the type is an error, as in a strict SQL cast.
    """
    return df.select(
        *[
            F.nullif(F.col(source), F.lit("")).cast(kind).alias(name)
            for name, (source, kind) in casts.items()
        ]
    )

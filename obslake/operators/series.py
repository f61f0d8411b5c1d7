"""Time-series operators: progress, change, rolling means, climatology, runs, trends.

Functions with a ``ranges`` argument use plain windows when it is None, which suits
calendar-grained input (months, days: a bounded number of rows per series). For raw
rows pass the ``balanced_ranges`` of the ordering column; the work then runs range by
range, with the same results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake.functions.calendar import day_of, month_of, near_edge
from obslake.functions.numbers import half_even, half_up, mean, percent
from obslake.operators.ordered import (
    Ranges, balanced_ranges, join_null_safe, lag_in_order, own_rows, row_index, running_count, with_rows_before,
)

ORIGIN_MILLIS = 946_684_800_000  # 2000-01-01: near the data, so that doubles made of the sums lose little


def exact_mean(value: str) -> Column:
    """Mean as total over count; over decimals it does not depend on row order."""
    return mean(F.sum(value), F.count(value))


def month_means(df: DataFrame, moment: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean per calendar month; months without rows do not appear."""
    month = month_of(F.col(moment)).alias("month_date")
    return df.groupBy(*by, month).agg(exact_mean(value).alias(value))


def day_means(df: DataFrame, moment: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean per UTC day."""
    return df.groupBy(*by, day_of(F.col(moment)).alias("day")).agg(exact_mean(value).alias(value))


# --- progress against an allowance -----------------------------------------------


def running_progress(
    months: DataFrame, allowances: DataFrame, season: str, month: str, amount: str, allowance: str
) -> DataFrame:
    """Running total per season and its percentage of the season's allowance.

    One row per (season, month) is expected, so a season is at most some dozen rows.
    Months without a reported amount are left out, not counted as zero.
    """
    reported = months.where(F.col(amount).isNotNull())
    so_far = F.sum(amount).over(Window.partitionBy(season).orderBy(month))
    return (
        reported.join(allowances.select(season, allowance), season)
        .withColumn("cumulative", so_far)
        .withColumn("cumulative_pct", half_up(percent(F.col("cumulative"), F.col(allowance)), 1))
    )


def same_point_last_season(
    progress: DataFrame, season_number: str, month_number: str, measure: str
) -> DataFrame:
    """The measure at the same calendar month one season earlier, NULL if there is none.

    One row per season and month is expected: the seasons of a month are few rows in order,
    and the one before counts if the two seasons adjoin.
    """
    by_month = Window.partitionBy(month_number).orderBy(season_number)
    earlier = F.lag(F.struct(season_number, measure)).over(by_month)
    adjoins = F.col("_earlier")[season_number] == F.col(season_number) - 1
    return (
        progress.withColumn("_earlier", earlier)
        .withColumn(f"{measure}_last_season", F.when(adjoins, F.col("_earlier")[measure]))
        .drop("_earlier")
    )


def months_into_season(months: DataFrame, season: str, month: str) -> DataFrame:
    """Ordinal of each month within its season, for overlaying seasons."""
    ordinal = F.row_number().over(Window.partitionBy(season).orderBy(month))
    return months.withColumn("month_no", ordinal)


# --- change and smoothing ------------------------------------------------------------


def period_change(
    df: DataFrame, order: str, value: str, by: Sequence[str] = (),
    ranges: Ranges | None = None,
) -> DataFrame:
    """Previous reported row's value and the change from it.

    "Previous" is the previous row that has a value, whatever the calendar gap.
    """
    reported = df.where(F.col(value).isNotNull())
    if ranges is None:
        previous = F.lag(value).over(Window.partitionBy(*by).orderBy(order))
        lagged = reported.withColumn("previous", previous)
    else:
        lagged = lag_in_order(reported, by, order, value, "previous", ranges)
    return lagged.withColumn("change", half_up(F.col(value) - F.col("previous"), 2))


def rolling_mean(
    df: DataFrame, order: str, value: str, rows: int, out: str, by: Sequence[str] = (),
    ranges: Ranges | None = None, calendar_strict: bool = False, tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Mean of the last ``rows`` rows, fewer at the start of a series.

    Counts rows: a missing month does not shorten the window. ``calendar_strict``
    averages the last ``rows`` calendar months instead. With ``ranges`` every range
    borrows the rows before it, from as many ranges as it takes; rows are shuffled once.
    """
    if calendar_strict:
        month = F.year(order) * 12 + F.month(order)
        if ranges is None:
            window = Window.partitionBy(*by).orderBy(month).rangeBetween(1 - rows, 0)
            return df.withColumn(out, half_up(F.avg(value).over(window), 2))
        # Rows become months first: a series has a bounded number of those.
        per_month = df.groupBy(*by, month.alias("_month")).agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
        window = Window.partitionBy(*by).orderBy("_month").rangeBetween(1 - rows, 0)
        smooth = mean(F.sum("_sum").over(window), F.sum("_n").over(window))
        smoothed = per_month.select(*by, "_month", half_up(smooth, 2).alias(out))
        return join_null_safe(df.withColumn("_month", month), smoothed, [*by, "_month"]).drop("_month")
    if ranges is None:
        window = Window.partitionBy(*by).orderBy(order, *tiebreak).rowsBetween(1 - rows, 0)
        return df.withColumn(out, half_up(F.avg(value).over(window), 2))
    haloed, window = with_rows_before(df, by, order, value, rows - 1, ranges, tiebreak)
    smooth = haloed.withColumn(out, half_up(F.avg(value).over(window.rowsBetween(1 - rows, 0)), 2))
    return own_rows(smooth)


# --- climatology and runs ------------------------------------------------------------


def climatology(
    df: DataFrame, value: str, season_key: Column, by: Sequence[str] = (), probability: float = 0.9
) -> DataFrame:
    """Mean and percentile over all years of the same calendar position.

    Input is one row per day or month, so a group holds as many rows as there are
    years. Exceedance is judged on unrounded values.
    """
    keyed = df.withColumn("_season", season_key)
    same = Window.partitionBy(*by, "_season")
    return (
        keyed.withColumn("clim_mean", F.avg(value).over(same))
        .withColumn("clim_p90", F.percentile(value, F.lit(probability)).over(same))
        .withColumn("is_warm", F.col(value) > F.col("clim_p90"))
        .drop("_season")
    )


def month_anomalies(months: DataFrame, value: str, probability: float = 0.9) -> DataFrame:
    """Monthly climatology, anomaly and warm flag; rounding comes last."""
    judged = climatology(months, value, F.month("month_date"), probability=probability)
    anomaly = half_even(F.col(value) - F.col("clim_mean"), 2)
    return judged.withColumn("anomaly", anomaly).withColumns(
        {c: half_even(F.col(c), 2) for c in (value, "clim_mean", "clim_p90")}
    )


def day_climatology(days: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Daily climatology per series and day of year, with the warm-day flag."""
    return climatology(days, value, F.dayofyear("day"), by)


def consecutive_runs(
    df: DataFrame,
    order: str,
    flag: str,
    measures: dict[str, Column],
    min_rows: int,
    by: Sequence[str] = (),
    ranges: Ranges | None = None,
    calendar_strict: bool = False,
) -> DataFrame:
    """Runs of consecutive flagged rows, at least ``min_rows`` long.

    The number of unflagged rows before a flagged row is the same all through its run.
    Counts rows: a missing day does not end a run, unless ``calendar_strict``.
    """
    unflagged = ~F.coalesce(F.col(flag), F.lit(False))
    in_order = Window.partitionBy(*by).orderBy(order)
    if calendar_strict:
        flagged = df.where(F.col(flag))
        if ranges is None:
            placed = flagged.withColumn("_place", F.row_number().over(in_order))
        else:
            placed = row_index(flagged, by, order, "_place", ranges)
        grouped = placed.withColumn("_run", F.unix_date(order) - F.col("_place"))
    elif ranges is None:
        gaps = F.count_if(unflagged).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
        grouped = df.withColumn("_run", gaps).where(F.col(flag))
    else:
        placed = running_count(df, by, order, unflagged, "_run", ranges)
        grouped = placed.where(F.col(flag))
    return (
        grouped.groupBy(*by, "_run")
        .agg(
            F.min(order).alias("run_start"),
            F.max(order).alias("run_end"),
            F.count(F.lit(1)).alias("n_rows"),
            *[m.alias(name) for name, m in measures.items()],
        )
        .where(F.col("n_rows") >= min_rows)
        .drop("_run")
    )


def calendar_runs(
    df: DataFrame, day: str, flag: str, measures: dict[str, Column], min_rows: int, by: Sequence[str] = ()
) -> DataFrame:
    """Runs of flagged days that follow each other in the calendar, at least ``min_rows`` long.

    A run is a session whose gap is one day, so nothing has to be numbered; one exchange.
    Rows of a day are aggregated before it: what one task gets of a series is a row a day.
    """
    # A session ends a gap after its last day: longer than one day, shorter than two.
    run = F.session_window(F.col(day).cast("timestamp_ntz"), "36 hours").alias("_run")
    return (
        df.where(F.col(flag)).groupBy(*by, run)
        .agg(
            F.min(day).alias("run_start"), F.max(day).alias("run_end"), F.count(F.lit(1)).alias("n_rows"),
            *[m.alias(name) for name, m in measures.items()],
        )
        .where(F.col("n_rows") >= min_rows)
        .drop("_run")
    )


# --- raw readings ----------------------------------------------------------------------


def reading_flags(
    readings: DataFrame,
    deployments: DataFrame,
    *,
    key: Sequence[str],
    moment: str,
    value: str,
    start: str,
    end: str,
    jump: float,
    margin: str = "6 hours",
    good: Column | None = None,
    tiebreak: Sequence[str] = (),
    ranges: Ranges | None = None,
) -> DataFrame:
    """Step from the previous good reading, spike flag and deployment-edge flag.

    Only readings judged good take part. The first of each deployment has no step
    and an unknown (NULL) spike flag. Runs over balanced time ranges: a deployment
    may hold any share of the readings.
    """
    kept = readings if good is None else readings.where(good)
    if ranges is None:
        ranges = balanced_ranges(kept, moment, tie=next(iter(tiebreak), None))
    stepped = lag_in_order(kept, key, moment, value, "_previous", ranges, tiebreak)
    return (
        stepped.withColumn("delta", F.col(value) - F.col("_previous"))
        .withColumn("flag_spike", F.abs("delta") > jump)
        .drop("_previous")
        .join(deployments, list(key))
        .withColumn("flag_boundary", near_edge(F.col(moment), F.col(start), F.col(end), margin))
    )


def unflagged(flags: DataFrame) -> DataFrame:
    """Readings known to be neither spike nor edge; an unknown flag drops the row."""
    return flags.where(~F.col("flag_spike") & ~F.col("flag_boundary"))


def pair_difference(
    df: DataFrame, at: str, series: str, value: str, first: object, second: object,
    names: tuple[str, str, str],
) -> DataFrame:
    """Two series side by side where both have a value, and first minus second.

    One pass and one shuffle in place of a self-join.
    """
    left, right, gap = names
    wide = df.where(F.col(series).isin(first, second)).groupBy(at).agg(
        F.max(F.when(F.col(series) == first, F.col(value))).alias(left),
        F.max(F.when(F.col(series) == second, F.col(value))).alias(right),
    )
    both = wide.where(F.col(left).isNotNull() & F.col(right).isNotNull())
    return both.withColumn(gap, half_up(F.col(left) - F.col(right), 2))


# --- trends --------------------------------------------------------------------------


def _slope(x: Column, y: Column, per: float) -> Column:
    """Least-squares slope over rows that have both, per ``per`` units of ``x``.

    ``x`` is a whole number, ``y`` a decimal; their sums and sums of products are exact, so
    the slope is the same, to the last bit, however rows are split over tasks. NULL without
    two different x.
    """
    both = x.isNotNull() & y.isNotNull()
    whole, amount = F.when(both, x).cast("decimal(15,0)"), F.when(both, y)
    n = F.count(whole)
    sums = [F.sum(v).cast("double") for v in (whole, amount, whole * amount, whole * whole)]
    sum_x, sum_y, sum_xy, sum_xx = sums
    spread = F.when(F.min(whole) < F.max(whole), sum_xx - sum_x * sum_x / n)
    return F.try_divide(sum_xy - sum_x * sum_y / n, spread) * per


def _amount(df: DataFrame, value: str) -> Column:
    """Decimals as they are; other numbers to six decimals."""
    kind = df.schema[value].dataType
    exact = isinstance(kind, T.DecimalType) and kind.precision <= 18
    return F.col(value) if exact else F.col(value).cast("decimal(18,6)")


def trend_per_year(df: DataFrame, value: str, moment: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares slope per year of 365.25 days, four decimals.

    Time counts in milliseconds. Sums are exact (see ``_slope``).
    """
    since = F.unix_millis(F.col(moment).cast("timestamp")) - ORIGIN_MILLIS
    slope = _slope(since, _amount(df, value), 365.25 * 24 * 3600 * 1000)
    return df.groupBy(*by).agg(half_up(slope, 4).alias("per_year"))


def trend_if_enough(df: DataFrame, value: str, date: str, more_than: int = 24) -> DataFrame:
    """Slope per year over days since the first date, only for longer records.

    The origin does not change a slope, so no pass is spent on finding the first date.
    """
    slope = _slope(F.unix_date(date), _amount(df, value), 365.25)
    enough = F.count(F.lit(1)) > more_than
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.when(enough, half_up(slope, 3)).alias("per_year")
    )


def year_means(days: DataFrame, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Yearly means of daily measures."""
    return days.groupBy(*by, F.year("day").alias("yr")).agg(*[F.avg(m).alias(m) for m in measures])

"""Ordered work over long series without pulling a series into one task.

A plain window partitioned by an entity sends the whole entity to one task, which
fails when one instrument holds a third of all readings. Here the ordering column
is cut into about equally full ranges, so that each (entity, range) is one modest
group; what a range needs from the ranges before it travels as a few summary rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake.session import stored

RANGE = "_range"
ROWS_PER_RANGE = 250_000
ACCURACY = 10_000  # of quantile sketches: their rank error is its reciprocal
GRID = 1024  # quantiles sketched in the pass that also counts the rows


class Crowded(NamedTuple):
    """A moment that alone overfills ranges, and the range it lies in."""

    at_range: int
    moment: object


@dataclass(frozen=True)
class Ranges:
    """Edges of the ranges of an ordering column.

    Edges are doubles; that moments a double cannot tell apart share a range does no
    harm. ``crowded`` moments are cut once more by the edges of ``tie``, the column that
    breaks ties. Edges decide about balance only: any edges, also those of another table,
    give the same results.
    """

    edges: tuple[float, ...] = ()
    crowded: tuple[Crowded, ...] = ()
    tie: str | None = None
    tie_edges: tuple[float, ...] = ()


def exact_key(df: DataFrame, column: str) -> Column:
    """The column as a number with the same order and the same equal values.

    Microseconds for timestamps, days for dates; numbers as they are. Of strings the
    first seven bytes count: an order that may see different strings as equal.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("bigint")
    if isinstance(kind, T.BooleanType):
        return F.col(column).cast("int")
    return F.col(column)


def order_key(df: DataFrame, column: str) -> Column:
    return exact_key(df, column).cast("double")


def balanced_ranges(
    df: DataFrame,
    order: str,
    parts: int | None = None,
    tie: str | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> Ranges:
    """Ranges that cut ``order`` into stretches of about ``rows_per_range`` rows.

    The edges come from one mergeable quantile sketch, which one pass over the column
    fills; ``parts`` asks for a number of ranges instead. A moment that alone holds more
    than a range's rows is cut by ``tie``. The driver receives the edges, never rows.
    """
    keyed = df.select(exact_key(df, order).alias("_key")).where("_key IS NOT NULL")
    rows, grid = keyed.agg(F.count("_key"), _sketch("_key", GRID)).first()
    parts = parts or -(-rows // rows_per_range)
    if not rows or parts < 2:
        return Ranges()
    if parts > GRID:
        grid = keyed.agg(_sketch("_key", parts)).first()[0]
    cuts = [grid[round(i * (len(grid) + 1) / parts) - 1] for i in range(1, parts)]
    edges = sorted({float(c) for c in cuts})
    repeated = {float(c): n for c, n in Counter(cuts).items() if n > 1}
    if not (repeated and tie):
        return Ranges(tuple(edges))
    # A sketch knows doubles only: which moment is it that fills the range?
    at_crowded = df.where(order_key(df, order).isin(list(repeated)))
    fullest = (
        at_crowded.groupBy(order_key(df, order).alias("_key"), exact_key(df, order).alias("_moment"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("_key").agg(F.max_by("_moment", F.struct("_n", "_moment")))
        .collect()
    )
    crowded = tuple(Crowded(bisect_right(edges, key), moment) for key, moment in sorted(fullest))
    within = balanced_ranges(at_crowded, tie, max(2, sum(repeated.values())))
    return Ranges(tuple(edges), crowded, tie, within.edges)


def _sketch(key: str, parts: int) -> Column:
    return F.percentile_approx(key, [i / parts for i in range(1, parts)], max(10_000, 20 * parts))


def _in_ranges(df: DataFrame, key: str, edges: Sequence[float], out: str) -> DataFrame:
    if not edges:
        return df.withColumn(out, F.lit(0.0))
    splits = [float("-inf"), *edges, float("inf")]
    cut = Bucketizer(splits=splits, inputCol=key, outputCol=out, handleInvalid="keep")
    return cut.transform(df)


def with_ranges(
    df: DataFrame, order: str, ranges: Ranges, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Add ``_range``, a number that grows with the order; NULL orders get range -1.

    A crowded moment is cut only if ties are broken by the column the edges were made
    for. Its range then has numbers of its own for the rows before the moment, for each
    stretch of ties, and for the rows after it.
    """
    keyed = _in_ranges(df.withColumn("_key", order_key(df, order)), "_key", ranges.edges, RANGE)
    number, extra = F.col(RANGE), ["_key"]
    if ranges.crowded and ranges.tie is not None and ranges.tie == next(iter(tiebreak), None):
        keyed = keyed.withColumn("_tie", order_key(df, ranges.tie))
        keyed = _in_ranges(keyed, "_tie", ranges.tie_edges, "_tie_range")
        stretches = len(ranges.tie_edges) + 2  # one more for NaN
        at_tie = F.when(F.col("_tie").isNull(), 0).otherwise(F.col("_tie_range"))
        exact, within = exact_key(df, order), F.lit(0)
        for at_range, moment in ranges.crowded:
            inside = F.when(exact < F.lit(moment), 0).when(exact == F.lit(moment), 1 + at_tie)
            within = F.when(F.col(RANGE) == at_range, inside.otherwise(1 + stretches)).otherwise(within)
        number = number * (stretches + 2) + within
        extra += ["_tie", "_tie_range"]
    placed = F.when(F.col("_key").isNull(), -1).otherwise(number).cast("int")
    return keyed.withColumn(RANGE, placed).drop(*extra)


def lag_in_order(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    value: str,
    out: str,
    ranges: Ranges,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Previous row's value within each entity, ordered by time.

    The last row of every (entity, range) is copied in front of the entity's next
    range; the window then never looks beyond its own range. One shuffle of the rows.
    """
    by, order_by = list(by), [order, *tiebreak]
    ranged = with_ranges(df, order, ranges, tiebreak)
    per_entity = Window.partitionBy(*by).orderBy(RANGE)
    carried = (
        _last_rows(ranged, [*by, RANGE], value, order_by)
        .withColumn("_next", F.lead(RANGE).over(per_entity))
        .where(F.col("_next").isNotNull())
        .select(*by, F.col("_next").alias(RANGE), value, *[c for c in order_by if c != value])
    )
    window = _front_row_first(by, order_by)
    lagged = _with_front_rows(ranged, carried).withColumn(out, F.lag(value).over(window))
    return lagged.where(~F.col("_front")).drop("_front", RANGE)


def _last_rows(ranged: DataFrame, group: Sequence[str], value: str, order_by: Sequence[str]) -> DataFrame:
    """The last row's value and order columns of each group.

    The largest moment of a group is found by hash, among all rows; only the rows at that
    moment are compared by the columns that break ties.
    """
    order, *ties = order_by
    kept = dict.fromkeys([*group, value, *order_by])
    if not ties:
        last = {c: F.max_by(c, order) for c in kept if c not in group and c != order}
        return ranged.groupBy(*group).agg(F.max(order).alias(order), *[m.alias(c) for c, m in last.items()])
    latest = ranged.groupBy(*group).agg(F.max(order).alias("_latest"))
    late = join_null_safe(ranged.select(*kept), latest, group).where(F.col(order).eqNullSafe(F.col("_latest")))
    last = F.max_by(F.struct(value, *order_by), F.struct(*ties)).alias("_last")
    rest = [F.col("_last")[c].alias(c) for c in kept if c not in group]
    return late.groupBy(*group).agg(last).select(*group, *rest)


def row_index(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    out: str,
    ranges: Ranges,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Exact 1-based position within each entity."""
    return running_count(df, by, order, F.lit(True), out, ranges, tiebreak)


def running_count(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    condition: Column,
    out: str,
    ranges: Ranges,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """How many rows of the entity meet the condition, up to and including each row.

    A row in front of every (entity, range) holds the count of the ranges before it.
    """
    by = list(by)
    hit = F.coalesce(condition, F.lit(False)).cast("int")
    ranged = with_ranges(df, order, ranges, tiebreak).withColumn("_hit", hit)
    offsets = _rows_before(ranged, by, F.sum("_hit")).select(*by, RANGE, "_before")
    window = _front_row_first(by, [order, *tiebreak])
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Both sums start at the row in front: it alone has an offset, and it has no hit.
    count = F.sum("_before").over(so_far) + F.coalesce(F.sum("_hit").over(so_far), F.lit(0))
    counted = _with_front_rows(ranged, offsets).withColumn(out, count.cast("bigint"))
    return counted.where(~F.col("_front")).drop("_front", "_before", "_hit", RANGE)


def with_rows_before(
    df: DataFrame, by: Sequence[str], order: str, value: str, count: int, ranges: Ranges, tiebreak: Sequence[str] = ()
) -> tuple[DataFrame, WindowSpec]:
    """Rows in ranges, each range with the entity's ``count`` rows before it, and their window.

    The last rows of every (entity, range) are cut out before they are shuffled. A range
    may be shorter than ``count``: its rows then go on to several later ranges, as far as
    the rows in between leave room. ``own_rows`` takes the borrowed rows away again.
    """
    by, order_by = list(by), [order, *tiebreak]
    ranged = with_ranges(df, order, ranges, tiebreak)
    backwards = Window.partitionBy(*by, RANGE).orderBy(*[F.col(c).desc_nulls_last() for c in order_by])
    kept = list(dict.fromkeys([*by, RANGE, value, *order_by]))
    ends = ranged.select(*kept).withColumn("_from_end", F.row_number().over(backwards)).where(F.col("_from_end") <= count)
    sizes = _rows_before(ranged, by, F.count(F.lit(1)))
    # Not more than ``count`` later ranges can borrow from a range: each holds a row at least.
    later = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(1, max(count, 1))
    behind = F.transform(
        F.collect_list(F.struct(RANGE, "_before")).over(later),
        lambda x: F.struct(x[RANGE].alias("_to"), (x["_before"] - F.col("_before") - F.col("_in_range")).alias("_between")),
    )
    targets = sizes.withColumn("_behind", behind).select(*by, RANGE, "_behind")
    near = F.filter("_behind", lambda x: x["_between"] + F.col("_from_end") <= count)
    borrowed = (
        join_null_safe(ends, targets, [*by, RANGE])
        .withColumn("_t", F.explode(near))
        .withColumn(RANGE, F.col("_t._to"))
        .drop("_from_end", "_behind", "_t")
    )
    return _with_front_rows(ranged, borrowed), _front_row_first(by, order_by)


def own_rows(haloed: DataFrame) -> DataFrame:
    return haloed.where(~F.col("_front")).drop("_front", RANGE)


def _with_front_rows(ranged: DataFrame, front: DataFrame) -> DataFrame:
    return ranged.withColumn("_front", F.lit(False)).unionByName(
        front.withColumn("_front", F.lit(True)), allowMissingColumns=True
    )


def _front_row_first(by: Sequence[str], order_by: Sequence[str]) -> WindowSpec:
    inside = [F.col(c).asc_nulls_first() for c in order_by]
    return Window.partitionBy(*by, RANGE).orderBy(F.col("_front").desc(), *inside)


def _rows_before(ranged: DataFrame, by: Sequence[str], size: Column) -> DataFrame:
    """Per (entity, range): rows in it, rows in earlier ranges, rows of the entity."""
    per_entity = Window.partitionBy(*by)
    in_order = per_entity.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.groupBy(*by, RANGE)
        .agg(size.alias("_in_range"))
        .withColumn("_before", F.coalesce(F.sum("_in_range").over(in_order), F.lit(0)))
        .withColumn("_rows", F.sum("_in_range").over(per_entity))
    )


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [left[key].eqNullSafe(renamed[f"_r_{key}"]) for key in keys]
    return left.join(renamed, reduce(and_, same)).drop(*[f"_r_{k}" for k in keys])


def quantile_profiles(
    df: DataFrame, by: Sequence[str], value: str, probabilities: Mapping[str, float], accuracy: int = ACCURACY
) -> DataFrame:
    """Per group, in one pass: _rows, _total, _low, _high, and the window each quantile lies in.

    A window reaches four times the error of the sketch to either side of its quantile.
    Groups of no more than ``accuracy`` rows have one window, all of their values.
    """
    measured = F.col(value).cast("double")
    reach = 4 / accuracy
    points = [q for p in probabilities.values() for q in (max(0.0, p - reach), min(1.0, p + reach))]
    profile = df.groupBy(*by).agg(
        F.count(value).alias("_rows"), F.sum(value).alias("_total"),
        F.min(measured).alias("_low"), F.max(measured).alias("_high"),
        F.percentile_approx(measured, points, accuracy).alias("_points"),
    )

    def point(i: int, whole: str) -> Column:
        """The sketch's value, or the extreme where it would be asked for that."""
        sketched = F.when(F.col("_rows") > accuracy, F.col("_points")[i]) if 0 < points[i] < 1 else F.lit(None)
        return F.coalesce(sketched, F.col(whole))

    windows = [
        F.struct(point(2 * i, "_low").alias("from"), point(2 * i + 1, "_high").alias("to")) for i in range(len(probabilities))
    ]
    return stored(profile.withColumn("_windows", F.array(*windows)).drop("_points"), "quantile-profiles")


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    accuracy: int = ACCURACY,
    approx: bool = False,
    profiles: DataFrame | None = None,
) -> DataFrame:
    """Interpolated quantiles per group, exact, for groups of any size, in two reads.

    The first read (``profiles``, if the caller has it) sketches a narrow window around
    each quantile; the second counts the rows below every window and, value by value, those
    inside, collapsing equal values before the shuffle. Returns the group columns and one
    double column per named probability; a group without values has NULLs. ``approx``
    takes the sketch alone, whose quantiles are values of the column.
    """
    by = list(by)
    measured = df.withColumn("_v", F.col(value).cast("double"))
    if approx:
        sketch = [F.percentile_approx("_v", p).alias(name) for name, p in probabilities.items()]
        return measured.groupBy(*by).agg(*sketch)
    if profiles is None:
        profiles = quantile_profiles(df, by, value, probabilities, accuracy)
    n = len(probabilities)
    present = measured.where("_v IS NOT NULL").select(*by, "_v")
    placed = _beside(present, profiles.select(*by, "_windows"), by)
    inside = F.exists("_windows", lambda w: F.col("_v").between(w["from"], w["to"]))
    below = [F.count_if(F.col("_v") < F.col("_windows")[i]["from"]).alias(f"_below{i}") for i in range(n)]
    counts = stored(
        placed.withColumn("_value", F.when(inside, F.col("_v"))).groupBy(*by, "_value").agg(F.count(F.lit(1)).alias("_n"), *below),
        "quantile-counts",
    )
    base = counts.groupBy(*by).agg(F.array(*[F.sum(f"_below{i}") for i in range(n)]).alias("_bases"))
    # From here on there are as many rows as values inside windows.
    known = _beside(_beside(counts.where("_value IS NOT NULL").select(*by, "_value", "_n"), profiles.select(*by, "_rows", "_windows"), by), base, by)
    at = known.select(*by, "_value", "_n", "_rows", "_bases", F.posexplode("_windows").alias("_i", "_w")).where(
        F.col("_value").between(F.col("_w")["from"], F.col("_w")["to"])
    )
    at = at.withColumn("_base", F.element_at("_bases", F.col("_i") + 1)).drop("_bases", "_w")
    ranged = with_ranges(at, "_value", balanced_ranges(counts, "_value"))
    offsets = _rows_before(ranged, [*by, "_i"], F.sum("_n")).select(*by, "_i", RANGE, "_before")
    running = Window.partitionBy(*by, "_i", RANGE).orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    counted = join_null_safe(ranged, offsets, [*by, "_i", RANGE])
    until = F.col("_base") + F.col("_before") + F.sum("_n").over(running)
    ranks = counted.withColumn("_until", until).withColumn("_from", F.col("_until") - F.col("_n"))
    held = lambda rank: (rank >= F.col("_from")) & (rank < F.col("_until"))
    measures = []
    for i, (name, p) in enumerate(probabilities.items()):
        low, high = _rank_pair(p)
        mine = F.col("_i") == i
        at_low, at_high = (F.max(F.when(mine & held(rank), F.col("_value"))) for rank in (low, high))
        share = F.max(F.lit(float(p)) * (F.col("_rows") - 1)) - F.max(low)
        lost = F.raise_error(F.lit("a quantile lies beyond the error of its sketch")).cast("double")
        none = F.when(F.count(F.lit(1)) == 0, F.lit(None))  # the one row of an empty column without groups
        value_at = none.when(at_low.isNull() | at_high.isNull(), lost).otherwise(at_low + (at_high - at_low) * share)
        measures.append(value_at.alias(name))
    found = ranks.groupBy(*by).agg(*measures, F.count(F.lit(1)).alias("_any")).where("_any > 0").drop("_any")
    missing = [F.lit(None).cast("double").alias(name) for name in probabilities]
    return found.unionByName(profiles.where("_rows = 0").select(*by, *missing))


def _beside(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Columns of the group's one row in ``right``; without groups there is one row in all."""
    if by:
        return join_null_safe(left, right, by)
    row = right.first()
    return left.withColumns({c: F.lit(row[c]).cast(kind) if not isinstance(row[c], list) else _listed(row[c], kind) for c, kind in right.dtypes})


def _listed(values: list, kind: str) -> Column:
    lits = [F.struct(*[F.lit(x).alias(f) for f, x in v.asDict().items()]) if isinstance(v, Row) else F.lit(v) for v in values]
    return F.array(*lits).cast(kind)


def _rank_pair(p: float) -> tuple[Column, Column]:
    position = F.lit(float(p)) * (F.col("_rows") - 1)
    return F.floor(position).cast("bigint"), F.ceil(position).cast("bigint")

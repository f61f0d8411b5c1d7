"""Reading flags, daily climatology, runs and differences over events and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.catalog.registry import Tables, amount, money, query, r, rounded
from obslake.functions.numbers import half_up, sign_class
from obslake.operators import keys, quality, series
from obslake.operators.ordered import Ranges, balanced_ranges, lag_in_order
from obslake.session import stored

GOOD_TYPES = ["view", "click", "purchase", "signup"]

FLAGS_SQL = """
good AS (SELECT * FROM events WHERE event_type IN ('view', 'click', 'purchase', 'signup')),
dim AS (SELECT event_type, MIN(ts) AS first_ts, MAX(ts) AS last_ts FROM events GROUP BY event_type),
stepped AS (
  SELECT g.event_id, g.event_type, g.ts, g.value,
         CAST(g.value AS DECIMAL(18,2)) - LAG(CAST(g.value AS DECIMAL(18,2)))
           OVER (PARTITION BY g.event_type ORDER BY g.ts, g.event_id) AS delta
  FROM good g
),
flags AS (
  SELECT s.event_id, s.event_type, s.ts, s.value, s.delta, ABS(s.delta) > 100 AS flag_spike,
         s.ts <= d.first_ts + INTERVAL 6 HOUR OR s.ts >= d.last_ts - INTERVAL 6 HOUR AS flag_boundary
  FROM stepped s JOIN dim d ON d.event_type = s.event_type
)"""


def event_flags(t: Tables) -> DataFrame:
    """Each event type as an instrument: steps, spikes and edges of its good readings."""
    readings = t.events.select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), money("value").alias("value")
    )
    spans = keys.derive_dimension(readings, ["event_type"], "ts", "first_ts", "last_ts")
    dim = stored(spans, "event-types")
    return series.reading_flags(
        readings, dim, key=["event_type"], moment="ts", value="value", start="first_ts",
        end="last_ts", jump=100, good=F.col("event_type").isin(GOOD_TYPES), tiebreak=["event_id"],
    )


@query(
    f"""WITH {FLAGS_SQL}
SELECT event_id, event_type, CAST(delta AS DOUBLE) AS delta, flag_spike, flag_boundary FROM flags"""
)
def q_spike_boundary(t: Tables) -> DataFrame:
    """Step, spike flag and edge flag of every good reading."""
    flags = event_flags(t)
    delta = F.col("delta").cast("double").alias("delta")
    return flags.select("event_id", "event_type", delta, "flag_spike", "flag_boundary")


@query(
    f"""WITH {FLAGS_SQL}
SELECT COUNT(*) AS n_good, COUNT(*) FILTER (WHERE flag_spike) AS n_spike,
       COUNT(*) FILTER (WHERE flag_boundary) AS n_boundary FROM flags"""
)
def q_flag_counts(t: Tables) -> DataFrame:
    """How many good readings each flag caught."""
    return quality.filtered_counts(
        event_flags(t), "n_good", {"n_spike": F.col("flag_spike"), "n_boundary": F.col("flag_boundary")}
    )


@query(
    f"""WITH {FLAGS_SQL}
SELECT event_type, CAST(ts AS DATE) AS day,
       {r("CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value)", 4)} AS value
FROM flags WHERE NOT flag_spike AND NOT flag_boundary GROUP BY ALL"""
)
def q_unflagged_daily(t: Tables) -> DataFrame:
    """Daily mean of readings known to be neither spike nor edge."""
    kept = series.unflagged(event_flags(t))
    return rounded(series.day_means(kept, "ts", "value", ["event_type"]), 4, "value")


DAILY_SQL = f"""
daily AS (
  SELECT l_returnflag, CAST(l_shipdate AS DATE) AS day,
         CAST(SUM({amount("l_extendedprice")}) AS DOUBLE) / COUNT(l_extendedprice) AS price
  FROM lineitem GROUP BY ALL
),
clim AS (
  SELECT l_returnflag, dayofyear(day) AS doy, AVG(price) AS clim_mean,
         QUANTILE_CONT(price, 0.9) AS clim_p90
  FROM daily GROUP BY ALL
),
judged AS (
  SELECT d.l_returnflag, d.day, d.price, c.clim_mean, c.clim_p90, d.price > c.clim_p90 AS is_warm
  FROM daily d JOIN clim c ON c.l_returnflag = d.l_returnflag AND c.doy = dayofyear(d.day)
)"""


def daily_prices(t: Tables, by: str = "l_returnflag") -> DataFrame:
    priced = t.lineitem.select(by, "l_shipdate", money("l_extendedprice").alias("price"))
    return series.day_means(priced, "l_shipdate", "price", [by])


def judged_days(t: Tables) -> DataFrame:
    return series.day_climatology(daily_prices(t), "price", ["l_returnflag"])


@query(
    f"""WITH {DAILY_SQL}
SELECT l_returnflag, day, {r("price", 4)} AS price, {r("clim_mean", 4)} AS clim_mean,
       {r("clim_p90", 4)} AS clim_p90, is_warm FROM judged"""
)
def q_daily_climatology(t: Tables) -> DataFrame:
    """Daily mean per return flag against its day of year over all years."""
    return rounded(judged_days(t), 4, "price", "clim_mean", "clim_p90")


RUNS_SQL = f"""
{DAILY_SQL},
flagged AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY day)
          - ROW_NUMBER() OVER (PARTITION BY l_returnflag, is_warm ORDER BY day) AS grp
  FROM judged
),
runs AS (
  SELECT l_returnflag, MIN(day) AS run_start, MAX(day) AS run_end, COUNT(*) AS n_rows,
         {r("AVG(price)", 2)} AS avg_price
  FROM flagged WHERE is_warm GROUP BY l_returnflag, grp HAVING COUNT(*) >= 3
)"""


def warm_runs(days: DataFrame, ranges: Ranges | None = None) -> DataFrame:
    measures = {"avg_price": half_up(F.avg("price"), 2)}
    return series.consecutive_runs(days, "day", "is_warm", measures, 3, ["l_returnflag"], ranges)


@query(f"WITH {RUNS_SQL} SELECT * FROM runs")
def q_spells_by_entity(t: Tables) -> DataFrame:
    """Runs of three or more warm days per return flag."""
    return warm_runs(judged_days(t))


@query(
    f"""WITH {DAILY_SQL}, warm AS (
  SELECT l_returnflag, day, price, day - CAST(ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY day) AS INT) AS grp
  FROM judged WHERE is_warm
)
SELECT l_returnflag, MIN(day) AS run_start, MAX(day) AS run_end, COUNT(*) AS n_rows, {r("AVG(price)", 2)} AS avg_price
FROM warm GROUP BY l_returnflag, grp HAVING COUNT(*) >= 2"""
)
def q_calendar_spells(t: Tables) -> DataFrame:
    """Runs of two or more warm days per return flag that follow each other in the calendar."""
    return series.calendar_runs(
        judged_days(t), "day", "is_warm", {"avg_price": half_up(F.avg("price"), 2)}, 2, ["l_returnflag"]
    )


@query(f"WITH {RUNS_SQL} SELECT * FROM runs ORDER BY run_start DESC NULLS FIRST, l_returnflag LIMIT 10")
def q_latest_spells(t: Tables) -> DataFrame:
    """The ten most recent warm runs, found over balanced ranges of days."""
    days = stored(judged_days(t), "judged-days")
    order = [F.col("run_start").desc_nulls_first(), "l_returnflag"]
    return warm_runs(days, balanced_ranges(days, "day")).orderBy(*order).limit(10)


@query(
    f"""WITH daily AS (
  SELECT l_linestatus, CAST(l_shipdate AS DATE) AS day,
         CAST(SUM({amount("l_extendedprice")}) AS DOUBLE) / COUNT(l_extendedprice) AS price
  FROM lineitem GROUP BY ALL
)
SELECT o.day, {r("o.price", 4)} AS open_price, {r("f.price", 4)} AS final_price,
       {r("o.price - f.price", 2)} AS gap,
       CASE WHEN {r("o.price - f.price", 2)} >= 0 THEN 'positive' ELSE 'negative' END AS gap_sign
FROM daily o JOIN daily f ON f.day = o.day WHERE o.l_linestatus = 'O' AND f.l_linestatus = 'F'"""
)
def q_pair_difference(t: Tables) -> DataFrame:
    """Daily mean price of open lines minus that of final lines, on days with both."""
    daily = daily_prices(t, "l_linestatus")
    names = ("open_price", "final_price", "gap")
    paired = series.pair_difference(daily, "day", "l_linestatus", "price", "O", "F", names)
    return rounded(paired, 4, "open_price", "final_price").withColumn("gap_sign", sign_class(F.col("gap")))


@query(
    f"""WITH {DAILY_SQL}
SELECT CAST(year(day) AS INT) AS yr, {r("AVG(price)", 4)} AS price, {r("AVG(clim_p90)", 4)} AS clim_p90
FROM judged WHERE l_returnflag = 'R' GROUP BY ALL"""
)
def q_year_mean(t: Tables) -> DataFrame:
    """Yearly mean of daily price and daily percentile for returned lines."""
    one = judged_days(t).where(F.col("l_returnflag") == "R")
    return rounded(series.year_means(one, ["price", "clim_p90"]), 4, "price", "clim_p90")


WIDE = 1 << 60  # beyond what a double holds to the unit


@query(
    f"""SELECT event_id, user_id, wide_key,
       lag(value) OVER (PARTITION BY event_type ORDER BY wide_key, event_id) AS previous
FROM (SELECT *, CAST({WIDE} AS BIGINT) + CAST(day(ts) % 5 AS BIGINT) AS wide_key FROM events)"""
)
def q_lag_wide_keys(t: Tables) -> DataFrame:
    """The previous value by a 64-bit key that few moments share, ties broken by id."""
    key = F.lit(WIDE).cast("bigint") + F.day("ts") % 5
    events = t.events.select("event_id", "user_id", "event_type", "value", key.alias("wide_key"))
    ranges = balanced_ranges(events, "wide_key", tie="event_id", rows_per_range=300)
    lagged = lag_in_order(events, ["event_type"], "wide_key", "value", "previous", ranges, ["event_id"])
    return lagged.select("event_id", "user_id", "wide_key", "previous")

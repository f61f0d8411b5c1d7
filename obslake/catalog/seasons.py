"""Seasonal progress, change and trends over orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.catalog.registry import Tables, amount, doubles, money, query, r, rounded
from obslake.functions.numbers import half_up
from obslake.operators import series
from obslake.operators.ordered import balanced_ranges
from obslake.session import stored

MONTHS_SQL = f"""
months AS (
  SELECT CAST(year(o_orderdate) AS INT) AS season,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS month_date,
         SUM({amount("o_totalprice")}) AS amount
  FROM orders GROUP BY ALL
)"""


def month_totals(t: Tables) -> DataFrame:
    month = F.trunc("o_orderdate", "month").alias("month_date")
    season = F.year("o_orderdate").alias("season")
    return t.orders.groupBy(season, month).agg(F.sum(money("o_totalprice")).alias("amount"))


def allowances(months: DataFrame) -> DataFrame:
    """Each season's allowance: 1.05 times the total of the season before."""
    total = F.round(F.sum("amount") * F.lit("1.05").cast("decimal(3,2)"), 2)
    return months.groupBy((F.col("season") + 1).alias("season")).agg(total.alias("allowance"))


PROGRESS_SQL = f"""
{MONTHS_SQL},
allowances AS (
  SELECT season + 1 AS season, ROUND(SUM(amount) * 1.05, 2) AS allowance FROM months GROUP BY season
),
progress AS (
  SELECT m.season, m.month_date, m.amount,
         SUM(m.amount) OVER (PARTITION BY m.season ORDER BY m.month_date) AS cumulative, a.allowance
  FROM months m JOIN allowances a ON a.season = m.season
  WHERE m.amount IS NOT NULL
)"""


def progress(t: Tables) -> DataFrame:
    months = month_totals(t)
    return series.running_progress(
        months, allowances(months), "season", "month_date", "amount", "allowance"
    )


@query(
    f"""WITH {PROGRESS_SQL}
SELECT season, month_date, CAST(amount AS DOUBLE) AS amount, CAST(cumulative AS DOUBLE) AS cumulative,
       CAST(allowance AS DOUBLE) AS allowance,
       {r("100.0 * CAST(cumulative AS DOUBLE) / CAST(allowance AS DOUBLE)", 1)} AS cumulative_pct
FROM progress ORDER BY season, month_date"""
)
def q_running_pct(t: Tables) -> DataFrame:
    """Running order total per season and its share of the season's allowance."""
    return doubles(progress(t), "amount", "cumulative", "allowance").orderBy("season", "month_date")


@query(
    f"""WITH {MONTHS_SQL}
SELECT season, month_date, CAST(amount AS DOUBLE) AS amount,
       CAST(LAG(amount) OVER (ORDER BY month_date) AS DOUBLE) AS previous,
       CAST(ROUND(amount - LAG(amount) OVER (ORDER BY month_date), 2) AS DOUBLE) AS change
FROM months WHERE amount IS NOT NULL"""
)
def q_period_change(t: Tables) -> DataFrame:
    """Month total against the previous month's."""
    return doubles(series.period_change(month_totals(t), "month_date", "amount"), "amount", "previous")


@query(
    f"""WITH {PROGRESS_SQL}
SELECT a.season, CAST(month(a.month_date) AS INT) AS month_no, CAST(a.cumulative AS DOUBLE) AS cumulative,
       CAST(b.cumulative AS DOUBLE) AS cumulative_last_season
FROM progress a LEFT JOIN progress b
  ON b.season = a.season - 1 AND month(b.month_date) = month(a.month_date)"""
)
def q_same_point_last_season(t: Tables) -> DataFrame:
    """Running total next to that of the same month one season earlier."""
    at_month = progress(t).select("season", F.month("month_date").alias("month_no"), "cumulative")
    compared = series.same_point_last_season(at_month, "season", "month_no", "cumulative")
    return doubles(compared, "cumulative", "cumulative_last_season")


@query(
    f"""WITH {MONTHS_SQL}
SELECT season, month_date, CAST(ROW_NUMBER() OVER (PARTITION BY season ORDER BY month_date) AS INT) AS month_no
FROM months"""
)
def q_months_into_season(t: Tables) -> DataFrame:
    """Ordinal of each month within its season."""
    numbered = series.months_into_season(month_totals(t), "season", "month_date")
    return numbered.select("season", "month_date", "month_no")


def mean_cents(total: str, count: str) -> str:
    """SQL for a mean of exact amounts, rounded half up to cents in whole numbers."""
    cents = f"CAST({total} * 100 AS HUGEINT)"
    return f"((2 * {cents} + {count}) // (2 * {count})) / 100"


MEANS_SQL = f"""
means AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_date,
         CAST(SUM({amount("o_totalprice")}) AS DOUBLE) / COUNT(o_totalprice) AS price
  FROM orders GROUP BY ALL
)"""


@query(
    f"""WITH {MEANS_SQL}
SELECT month_date, {r("price", 4)} AS price,
       {r("AVG(price) OVER (ORDER BY month_date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)", 2)} AS rolling
FROM means"""
)
def q_rolling_12(t: Tables) -> DataFrame:
    """Monthly mean order price with the mean of its last twelve months."""
    priced = t.orders.select("o_orderdate", money("o_totalprice").alias("price"))
    months = series.month_means(priced, "o_orderdate", "price")
    return rounded(series.rolling_mean(months, "month_date", "price", 12, "rolling"), 4, "price")


@query(
    f"""WITH daily AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, SUM({amount("o_totalprice")}) AS price
  FROM orders GROUP BY ALL
)
SELECT o_custkey, day, CAST(price AS DOUBLE) AS price,
       {mean_cents("SUM(price) OVER last3", "COUNT(*) OVER last3")} AS rolling,
       CAST(LAG(price) OVER (PARTITION BY o_custkey ORDER BY day) AS DOUBLE) AS previous
FROM daily WINDOW last3 AS (PARTITION BY o_custkey ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""
)
def q_rolling_by_entity(t: Tables) -> DataFrame:
    """Rolling mean and previous value per customer, over balanced ranges of days."""
    day = F.to_date("o_orderdate").alias("day")
    daily = t.orders.groupBy("o_custkey", day).agg(F.sum(money("o_totalprice")).alias("price"))
    daily, by = stored(daily, "daily"), ["o_custkey"]
    ranges = balanced_ranges(daily, "day", rows_per_range=50_000)
    changed = stored(series.period_change(daily, "day", "price", by, ranges).drop("change"), "changed")
    smooth = series.rolling_mean(changed, "day", "price", 3, "rolling", by, ranges)
    return doubles(smooth, "price", "previous")


@query(
    f"""WITH calendar AS (
  SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_date,
         SUM({amount("o_totalprice")}) AS price
  FROM orders GROUP BY ALL
)
SELECT a.o_custkey, a.month_date, {mean_cents("SUM(b.price)", "COUNT(*)")} AS rolling
FROM calendar a JOIN calendar b ON b.o_custkey = a.o_custkey
 AND b.month_date <= a.month_date AND b.month_date > a.month_date - INTERVAL 12 MONTH
GROUP BY a.o_custkey, a.month_date"""
)
def q_rolling_calendar(t: Tables) -> DataFrame:
    """Rolling mean over twelve calendar months per customer, whatever months are missing."""
    month = F.trunc("o_orderdate", "month").alias("month_date")
    totals = t.orders.groupBy("o_custkey", month).agg(F.sum(money("o_totalprice")).alias("price"))
    smooth = series.rolling_mean(
        totals, "month_date", "price", 12, "rolling", ["o_custkey"], calendar_strict=True,
    )
    return smooth.drop("price")


CLIMATE_SQL = f"""
monthly AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_date,
         CAST(SUM({amount("l_extendedprice")}) AS DOUBLE) / COUNT(l_extendedprice) AS price
  FROM lineitem GROUP BY ALL
),
clim AS (
  SELECT month(month_date) AS m, AVG(price) AS clim_mean, QUANTILE_CONT(price, 0.9) AS clim_p90
  FROM monthly GROUP BY ALL
),
judged AS (
  SELECT month_date, price, clim_mean, clim_p90, price > clim_p90 AS is_warm
  FROM monthly JOIN clim ON m = month(month_date)
)"""


def ship_months(t: Tables) -> DataFrame:
    priced = t.lineitem.select("l_shipdate", money("l_extendedprice").alias("price"))
    return series.month_means(priced, "l_shipdate", "price")


@query(
    f"""WITH {CLIMATE_SQL}
SELECT month_date, {r("price", 2)} AS price, {r("clim_mean", 2)} AS clim_mean,
       {r("clim_p90", 2)} AS clim_p90, {r("price - clim_mean", 2)} AS anomaly, is_warm
FROM judged"""
)
def q_monthly_climatology(t: Tables) -> DataFrame:
    """Month mean price against all years' mean and 90th percentile of that month."""
    return series.month_anomalies(ship_months(t), "price")


@query(
    f"""WITH {CLIMATE_SQL},
flagged AS (
  SELECT month_date, price, clim_mean,
         ROW_NUMBER() OVER (ORDER BY month_date)
         - ROW_NUMBER() OVER (PARTITION BY price > clim_mean ORDER BY month_date) AS grp
  FROM judged
)
SELECT MIN(month_date) AS run_start, MAX(month_date) AS run_end, COUNT(*) AS n_rows,
       {r("AVG(price - clim_mean)", 2)} AS avg_anomaly, {r("MAX(price - clim_mean)", 2)} AS peak_anomaly
FROM flagged WHERE price > clim_mean GROUP BY grp HAVING COUNT(*) >= 2"""
)
def q_warm_spells(t: Tables) -> DataFrame:
    """Runs of two or more months above their climatological mean."""
    judged = series.climatology(ship_months(t), "price", F.month("month_date"))
    gap = F.col("price") - F.col("clim_mean")
    measures = {"avg_anomaly": half_up(F.avg(gap), 2), "peak_anomaly": half_up(F.max(gap), 2)}
    above = judged.withColumn("above", gap > 0)
    return series.consecutive_runs(above, "month_date", "above", measures, 2)


EPOCH_YEARS = "epoch(l_shipdate) / (365.25 * 24 * 3600)"


@query(f"SELECT {r(f'REGR_SLOPE(l_extendedprice, {EPOCH_YEARS})', 4)} AS per_year FROM lineitem")
def q_trend_global(t: Tables) -> DataFrame:
    """Slope of line price per year."""
    return series.trend_per_year(t.lineitem, "l_extendedprice", "l_shipdate")


@query(
    f"""SELECT l_returnflag, {r(f"REGR_SLOPE(l_extendedprice, {EPOCH_YEARS})", 4)} AS per_year
FROM lineitem WHERE l_linestatus IN ('O', 'F') GROUP BY l_returnflag"""
)
def q_trend_by_group(t: Tables) -> DataFrame:
    """Slope of line price per year and return flag, over known line states."""
    good = t.lineitem.where(F.col("l_linestatus").isin("O", "F"))
    return series.trend_per_year(good, "l_extendedprice", "l_shipdate", ["l_returnflag"])


@query(
    f"""WITH {MEANS_SQL}, origin AS (SELECT MIN(month_date) AS first_month FROM means)
SELECT COUNT(*) AS n_rows,
       CASE WHEN COUNT(*) > 24
            THEN {r("REGR_SLOPE(price, date_diff('day', first_month, month_date) / 365.25)", 3)} END AS per_year
FROM means, origin"""
)
def q_trend_guarded(t: Tables) -> DataFrame:
    """Slope of the monthly mean price, given only for more than 24 months."""
    priced = t.orders.select("o_orderdate", money("o_totalprice").alias("price"))
    return series.trend_if_enough(series.month_means(priced, "o_orderdate", "price"), "price", "month_date")

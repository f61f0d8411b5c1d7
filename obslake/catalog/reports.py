"""Indexing, axis limits, slices and latest rows for displays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.catalog.registry import Tables, amount, money, query, r, rounded
from obslake.catalog.surveys import PANEL_SQL, customer_panel
from obslake.operators import stats
from obslake.operators.ordered import exact_quantiles

YEARLY_SQL = f"""
yearly AS (
  SELECT o_orderpriority, CAST(year(o_orderdate) AS INT) AS yr,
         CAST(SUM({amount("o_totalprice")}) AS DOUBLE) / COUNT(*) AS mean_price, MAX(o_totalprice) AS top_price
  FROM orders GROUP BY ALL)"""


def yearly_prices(t: Tables) -> DataFrame:
    total = F.sum(money("o_totalprice")).cast("double")
    return t.orders.groupBy("o_orderpriority", F.year("o_orderdate").alias("yr")).agg(
        (total / F.count(F.lit(1))).alias("mean_price"), F.max("o_totalprice").alias("top_price")
    )


@query(
    f"""WITH {YEARLY_SQL}, bounds AS (
  SELECT o_orderpriority, MIN(mean_price) AS lo, MAX(mean_price) AS hi FROM yearly GROUP BY ALL)
SELECT y.o_orderpriority, yr, {r("CASE WHEN hi > lo THEN (mean_price - lo) / (hi - lo) * 100 ELSE 0 END", 4)} AS price_index
FROM yearly y JOIN bounds b ON b.o_orderpriority = y.o_orderpriority"""
)
def q_index_minmax(t: Tables) -> DataFrame:
    """Yearly mean price on a 0-100 scale within each priority."""
    scaled = stats.indexed(yearly_prices(t), "mean_price", "price_index", ["o_orderpriority"])
    return rounded(scaled.select("o_orderpriority", "yr", "price_index"), 4, "price_index")


@query(
    f"""WITH {YEARLY_SQL}, bounds AS (
  SELECT LEAST(MIN(mean_price), MIN(top_price)) AS lo, GREATEST(MAX(mean_price), MAX(top_price)) AS hi FROM yearly)
SELECT o_orderpriority, yr, {r("(mean_price - lo) / (hi - lo) * 100", 4)} AS mean_index,
       {r("(top_price - lo) / (hi - lo) * 100", 4)} AS top_index
FROM yearly, bounds"""
)
def q_index_joint(t: Tables) -> DataFrame:
    """Mean and top price on one common 0-100 scale."""
    both = {"mean_price": "mean_index", "top_price": "top_index"}
    scaled = stats.indexed_jointly(yearly_prices(t), both)
    kept = scaled.select("o_orderpriority", "yr", "mean_index", "top_index")
    return rounded(kept, 4, "mean_index", "top_index")


@query(
    f"""WITH {YEARLY_SQL}
SELECT {r("LEAST(MIN(mean_price), MIN(top_price)) - 0.5", 4)} AS axis_low,
       {r("GREATEST(MAX(mean_price), MAX(top_price)) + 0.5", 4)} AS axis_high FROM yearly"""
)
def q_axis_range(t: Tables) -> DataFrame:
    """Padded limits over both price columns."""
    limits = stats.axis_range(yearly_prices(t), ["mean_price", "top_price"], 0.5)
    return rounded(limits, 4, "axis_low", "axis_high")


@query(
    f"""WITH {PANEL_SQL}
SELECT p.site, p.yr, p.richness, p.biomass FROM panel p JOIN customer c ON c.c_custkey = p.site
WHERE p.richness IS NOT NULL AND p.biomass IS NOT NULL AND c.c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')
  AND p.yr BETWEEN 1996 AND 1999"""
)
def q_filtered_slice(t: Tables) -> DataFrame:
    """Complete customer years of two segments within a span of years."""
    segments = t.customer.where(F.col("c_mktsegment").isin("HOUSEHOLD", "MACHINERY"))
    chosen = customer_panel(t, segments.select(F.col("c_custkey").alias("site")), (1996, 1999))
    return chosen.dropna(subset=["richness", "biomass"]).select("site", "yr", "richness", "biomass")


@query("SELECT * FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'")
def q_slice_entity(t: Tables) -> DataFrame:
    """Orders of one priority and state."""
    return t.orders.where((F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "P"))


@query("SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts DESC NULLS FIRST, event_id LIMIT 30")
def q_latest_n(t: Tables) -> DataFrame:
    """The thirty latest events."""
    events = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    return stats.latest_rows(events, "ts", 30, [F.col("event_id")])


@query(
    """SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""
)
def q_latest_per_entity(t: Tables) -> DataFrame:
    """The last event of every user."""
    events = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    return stats.latest_per_entity(events, ["user_id"], "ts", ["event_id"])


@query("SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def q_latest_row(t: Tables) -> DataFrame:
    """The last event of all."""
    events = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    return stats.latest_per_entity(events, [], "ts", ["event_id"])


@query(
    f"""SELECT event_type, {r("QUANTILE_CONT(value, 0.1)", 4)} AS p10, {r("QUANTILE_CONT(value, 0.5)", 4)} AS p50,
       {r("QUANTILE_CONT(value, 0.9)", 4)} AS p90 FROM events GROUP BY event_type"""
)
def q_exact_quantiles(t: Tables) -> DataFrame:
    """Exact interpolated quantiles per event type, for groups of any size."""
    found = exact_quantiles(t.events, ["event_type"], "value", {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    return rounded(found, 4, "p10", "p50", "p90")


@query(
    f"""WITH v AS (SELECT CAST(event_id % 3 AS INTEGER) AS place,
           CASE WHEN event_id % 3 < 2 THEN pow(2, (event_id * 7919) % 40) + (event_id % 10) / 10.0 END AS v FROM events)
SELECT place, {r("QUANTILE_CONT(v, 0.05)", 3)} AS p05, {r("QUANTILE_CONT(v, 0.5)", 3)} AS p50, {r("QUANTILE_CONT(v, 0.97)", 3)} AS p97
FROM v GROUP BY place"""
)
def q_skewed_quantiles(t: Tables) -> DataFrame:
    """Exact quantiles of values spread over forty powers of two, one group without any."""
    spread = F.pow(F.lit(2.0), (F.col("event_id") * 7919) % 40) + (F.col("event_id") % 10) / 10.0
    values = t.events.select(
        (F.col("event_id") % 3).cast("int").alias("place"), F.when(F.col("event_id") % 3 < 2, spread).alias("v")
    )
    found = exact_quantiles(values, ["place"], "v", {"p05": 0.05, "p50": 0.5, "p97": 0.97})
    return rounded(found, 3, "p05", "p50", "p97")

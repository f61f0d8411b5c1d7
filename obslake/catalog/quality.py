"""Rule reports, reconciliation, constraints and the two-tier gate."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.catalog.loading import AUDIT_SQL, LINE_KEY, counted_loads
from obslake.catalog.registry import Tables, amount, doubles, money, query, r
from obslake.functions.calendar import decade_of, span_years
from obslake.operators import quality, stats
from obslake.operators.cleaning import plausible

AS_OF = datetime(2024, 2, 20, 12, 0, 0)


@query("SELECT l_returnflag, l_linestatus, COUNT(*) AS n_rows FROM lineitem GROUP BY ALL")
def q_group_counts(t: Tables) -> DataFrame:
    """Rows per return flag and line state."""
    return quality.group_counts(t.lineitem, ["l_returnflag", "l_linestatus"])


@query(
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1"
)
def q_duplicates(t: Tables) -> DataFrame:
    """Order and line numbers that occur more than once."""
    return quality.duplicate_keys(t.lineitem, LINE_KEY)


def line_sums(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(money("l_extendedprice")).alias("summed")
    )


SUMS_SQL = f"""
sums AS (SELECT l_orderkey AS o_orderkey, SUM({amount("l_extendedprice")}) AS summed
         FROM lineitem GROUP BY l_orderkey)"""


@query(
    f"""WITH {SUMS_SQL}
SELECT o.o_orderkey, CAST(s.summed AS DOUBLE) AS summed, CAST({amount("o.o_totalprice")} AS DOUBLE) AS stated,
       CAST(s.summed - {amount("o.o_totalprice")} AS DOUBLE) AS diff
FROM orders o JOIN sums s ON s.o_orderkey = o.o_orderkey
WHERE ABS(s.summed - {amount("o.o_totalprice")}) > 0.5"""
)
def q_reconcile(t: Tables) -> DataFrame:
    """Orders whose lines do not add up to the stated total."""
    stated = t.orders.select("o_orderkey", money("o_totalprice").alias("stated"))
    found = quality.reconciliation_exceptions(
        line_sums(t), stated, ["o_orderkey"], "summed", "stated", 0.5
    )
    return doubles(found, "stated")


@query(
    f"""WITH {SUMS_SQL}
SELECT o.o_orderkey, CAST({amount("o.o_totalprice")} AS DOUBLE) AS stated, CAST(s.summed AS DOUBLE) AS summed,
       CAST({amount("o.o_totalprice")} - s.summed AS DOUBLE) AS diff,
       COALESCE(ABS({amount("o.o_totalprice")} - s.summed) < 5000, FALSE) AS reconciles
FROM orders o LEFT JOIN sums s ON s.o_orderkey = o.o_orderkey"""
)
def q_reconcile_report(t: Tables) -> DataFrame:
    """Every order's stated total next to the sum of its lines."""
    stated = t.orders.select("o_orderkey", money("o_totalprice").alias("stated"))
    report = quality.reconciliation_report(
        stated, line_sums(t), ["o_orderkey"], "stated", "summed", 5000
    )
    return doubles(report, "stated")


@query(
    """SELECT c.c_custkey, c.c_name FROM customer c
LEFT JOIN (SELECT o_custkey, MAX(o_orderdate) AS last_order FROM orders
           WHERE year(o_orderdate) = 1998 GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey
WHERE o.last_order IS NULL OR c.c_name IS NULL"""
)
def q_not_null(t: Tables) -> DataFrame:
    """Customers without a required last order date in one season."""
    in_season = F.when(F.year("o_orderdate") == 1998, F.col("o_orderdate"))
    last = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max(in_season).alias("last_order")
    )
    joined = t.customer.join(last, "c_custkey", "left")
    return quality.missing_rows(joined, ["last_order", "c_name"]).select("c_custkey", "c_name")


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE l_quantity IS NULL OR l_quantity NOT BETWEEN 3 AND 48
   OR (l_discount IS NOT NULL AND l_discount NOT BETWEEN 0 AND 0.08)"""
)
def q_range_violations(t: Tables) -> DataFrame:
    """Lines with quantity or discount out of bounds."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return quality.out_of_range(lines, {"l_quantity": (3, 48)}, {"l_discount": (0, 0.08)})


@query(
    """SELECT p.p_partkey AS l_partkey, COUNT(*) AS n_rows
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
WHERE NOT p.p_size BETWEEN 1 AND 40 GROUP BY ALL"""
)
def q_orphans(t: Tables) -> DataFrame:
    """Part keys of lines that are missing from the dimension of plausible parts."""
    dim = t.part.where(plausible({"p_size": (1, 40)})).select(F.col("p_partkey").alias("l_partkey"))
    return quality.orphan_keys(t.lineitem, dim, ["l_partkey"])


@query(
    """SELECT c.c_custkey, c.c_name, COUNT(o.o_orderkey) AS n_orders FROM customer c
LEFT JOIN (SELECT * FROM orders WHERE year(o_orderdate) = 1998) o ON o.o_custkey = c.c_custkey
GROUP BY ALL"""
)
def q_coverage_left(t: Tables) -> DataFrame:
    """Orders per customer in one season, customers without any included."""
    fact = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    dim = t.customer.select("c_custkey", "c_name")
    return quality.coverage(dim, fact, ["c_custkey"], "n_orders", F.year("o_orderdate") == 1998)


@query(
    """SELECT 'value in range' AS rule, COUNT(*) FILTER (WHERE NOT value BETWEEN 0 AND 400) AS violations FROM events
UNION ALL SELECT 'type present', COUNT(*) FILTER (WHERE event_type IS NULL) FROM events
UNION ALL SELECT 'one event per user, type and day', (SELECT COUNT(*) FROM
  (SELECT 1 FROM (SELECT user_id, event_type, CAST(ts AS DATE) AS day FROM events)
   GROUP BY user_id, event_type, day HAVING COUNT(*) > 1))
UNION ALL SELECT 'user known', (SELECT COUNT(*) FROM events
  WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0))"""
)
def q_constraints(t: Tables) -> DataFrame:
    """Violations of check, uniqueness and reference rules on events."""
    events = t.events.select("user_id", "event_type", "value", F.to_date("ts").alias("day"))
    known = t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("user_id"))
    return quality.constraint_report(
        events,
        {
            "value in range": F.col("value").between(0, 400),
            "type present": F.col("event_type").isNotNull(),
        },
        unique={"one event per user, type and day": ["user_id", "event_type", "day"]},
        references={"user known": (known, ["user_id"])},
    )


@query("SELECT MAX(ts) AS latest, CAST(floor(epoch(TIMESTAMP '2024-02-20 12:00:00' - MAX(ts)) / 86400) AS BIGINT) AS age_days FROM events")
def q_freshness(t: Tables) -> DataFrame:
    """Newest event and its age at a given moment."""
    fresh = quality.freshness(t.events, "ts", AS_OF)
    return fresh.withColumn("latest", F.col("latest").cast("timestamp_ntz"))


BAD_SQL = r("100.0 * COUNT(*) FILTER (WHERE event_type IN ('error', 'signup')) / COUNT(*)", 1)


@query(f"SELECT user_id, {BAD_SQL} AS bad_pct FROM events GROUP BY user_id HAVING {BAD_SQL} > 45")
def q_bad_rate(t: Tables) -> DataFrame:
    """Users with more than 45 % of events of a bad type."""
    return quality.bad_rates(t.events, ["user_id"], F.col("event_type").isin("error", "signup"), 45)


@query(
    f"""WITH {AUDIT_SQL},
dupes AS (SELECT COUNT(*) AS n FROM (SELECT 1 FROM events GROUP BY event_id HAVING COUNT(*) > 1)),
wrong AS (SELECT COUNT(*) AS n FROM events WHERE NOT value BETWEEN 0 AND 400),
orphans AS (SELECT COUNT(*) AS n FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)),
age AS (SELECT floor(epoch(TIMESTAMP '2024-02-20 12:00:00' - MAX(ts)) / 86400) AS n FROM events),
noisy AS (SELECT user_id, {BAD_SQL} AS bad_pct FROM events GROUP BY user_id HAVING {BAD_SQL} > 45),
rejected AS (SELECT 100.0 * (rows_source - rows_loaded) / rows_source AS pct FROM loads WHERE load_id = 2),
gate AS (
  SELECT 'duplicate_keys' AS "check", 'FAIL' AS tier, NULL AS subject, n AS observed, 0 AS threshold FROM dupes
  UNION ALL SELECT 'out_of_range', 'FAIL', NULL, n, 0 FROM wrong
  UNION ALL SELECT 'orphans', 'FAIL', NULL, n, 0 FROM orphans
  UNION ALL SELECT 'age_days', 'WARN', NULL, n, 14 FROM age
  UNION ALL SELECT 'bad_pct', 'WARN', CAST(user_id AS VARCHAR), bad_pct, 45 FROM noisy
  UNION ALL SELECT 'rejected_pct', 'WARN', NULL, pct, 5 FROM rejected
)
SELECT "check", tier, subject, {r("observed", 4)} AS observed, CAST(threshold AS DOUBLE) AS threshold,
       observed <= threshold AS ok FROM gate"""
)
def q_quality_gate(t: Tables) -> DataFrame:
    """Failures and warnings over events, customers as their dimension, and the load trail."""
    known = t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("user_id"))
    gate = quality.quality_gate(
        t.events, known, counted_loads(t), key=["event_id"], dim_key=["user_id"],
        required={}, optional={"value": (0, 400)}, moment="ts", as_of=AS_OF,
        bad=F.col("event_type").isin("error", "signup"), bad_by=["user_id"], max_bad_pct=45,
    )
    return gate.withColumn("observed", F.round(F.col("observed").cast("decimal(28,10)"), 4).cast("double"))


@query(
    """SELECT CAST((year(o_orderdate) // 10) * 10 AS INT) AS decade, COUNT(*) AS n_orders
FROM orders GROUP BY ALL"""
)
def q_decade_coverage(t: Tables) -> DataFrame:
    """Orders per decade."""
    decades = t.orders.groupBy(decade_of(F.year("o_orderdate")).alias("decade"))
    return decades.agg(F.count(F.lit(1)).alias("n_orders"))


@query(
    f"""SELECT COUNT(*) AS n_rows, COUNT(DISTINCT o_custkey) AS n_entities, MIN(o_orderdate) AS earliest,
       MAX(o_orderdate) AS latest,
       {r("date_diff('day', MIN(o_orderdate), MAX(o_orderdate)) / 365.25", 4)} AS span_years FROM orders"""
)
def q_coverage_summary(t: Tables) -> DataFrame:
    """Rows, customers, first and last date, and the years between them."""
    summary = stats.coverage_summary(t.orders, "o_custkey", "o_orderdate")
    span = F.round(span_years(F.col("earliest"), F.col("latest")).cast("decimal(28,10)"), 4)
    return summary.withColumn("span_years", span.cast("double"))


@query(
    """SELECT COUNT(*) AS n_before, COUNT(*) FILTER (WHERE l_quantity BETWEEN 3 AND 48) AS n_quantity,
       COUNT(*) FILTER (WHERE l_quantity BETWEEN 3 AND 48 AND l_discount BETWEEN 0 AND 0.08) AS n_discount
FROM lineitem"""
)
def q_filter_funnel(t: Tables) -> DataFrame:
    """Lines left after each plausibility filter."""
    return quality.filter_funnel(
        t.lineitem,
        {
            "n_quantity": plausible({"l_quantity": (3, 48)}),
            "n_discount": plausible({"l_discount": (0, 0.08)}),
        },
    )


@query(
    f"""SELECT o_custkey, COUNT(*) AS n_flagged, CAST(SUM({amount("o_totalprice")}) AS DOUBLE) AS total
FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000 GROUP BY o_custkey"""
)
def q_flagged(t: Tables) -> DataFrame:
    """Flagged orders per customer."""
    flag = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000)
    flagged = t.orders.withColumn("any_flag", flag).where("any_flag")
    total = F.sum(money("o_totalprice")).cast("double").alias("total")
    return flagged.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_flagged"), total)

"""Detection, spread, panels, lagged predictors and trends over sales as a survey.

Suppliers and customers stand for sites, returned lines for sightings of a species.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.catalog.registry import Tables, amount, doubles, money, query, r, rounded
from obslake.functions.numbers import ordered_tier
from obslake.functions.text import display_label
from obslake.operators import panel, stats
from obslake.operators.keys import union_keys
from obslake.session import stored

SHIP_YEAR = "CAST(year(l_shipdate) AS INT)"
SEEN_SQL = "l_returnflag = 'R' AND l_quantity > 44 AND l_discount >= 0.07"


def ship_year():
    return F.year("l_shipdate")


def is_seen():
    return (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 44) & (F.col("l_discount") >= 0.07)


@query(
    f"""WITH surveyed AS (SELECT l_suppkey, MIN({SHIP_YEAR}) AS first_survey FROM lineitem GROUP BY l_suppkey),
found AS (
  SELECT l_suppkey, MIN(l_extendedprice) AS l_extendedprice, MIN(l_tax) AS l_tax,
         MIN({SHIP_YEAR}) AS first_detected_year
  FROM lineitem WHERE {SEEN_SQL} GROUP BY l_suppkey)
SELECT f.l_suppkey, f.l_extendedprice, f.l_tax, f.first_detected_year,
       f.first_detected_year = s.first_survey AS is_confounded
FROM found f JOIN surveyed s ON s.l_suppkey = f.l_suppkey"""
)
def q_first_detection(t: Tables) -> DataFrame:
    """First year each supplier had a large returned line, and whether it was its first year."""
    return panel.first_detection(
        t.lineitem, "l_suppkey", ship_year(), is_seen(), ["l_extendedprice", "l_tax"]
    )


@query(
    f"""SELECT {SHIP_YEAR} AS yr, COUNT(DISTINCT l_suppkey) AS n_sites FROM lineitem
WHERE {SEEN_SQL} GROUP BY ALL"""
)
def q_colonised_by_year(t: Tables) -> DataFrame:
    """Suppliers with a sighting per year."""
    return panel.sites_by_year(t.lineitem, "l_suppkey", ship_year(), is_seen())


@query(f"SELECT {SHIP_YEAR} AS yr, MIN(l_extendedprice) AS edge FROM lineitem WHERE {SEEN_SQL} GROUP BY ALL")
def q_range_edge(t: Tables) -> DataFrame:
    """Lowest price with a sighting per year."""
    return panel.range_edge(t.lineitem, "l_extendedprice", ship_year(), is_seen())


@query(
    f"""SELECT count(*) AS n_records, count(DISTINCT {SHIP_YEAR}) AS n_years, count(DISTINCT l_suppkey) AS n_places,
       CAST(min({SHIP_YEAR}) AS INTEGER) AS first_year, CAST(max({SHIP_YEAR}) AS INTEGER) AS last_year,
       {r("CAST(SUM(" + amount("l_extendedprice") + ") AS DOUBLE) / count(*)", 4)} AS mean_price,
       {r("CAST(count(*) FILTER (WHERE l_linestatus = 'O') AS DOUBLE) / count(*)", 6)} AS confounded_share
FROM lineitem WHERE {SEEN_SQL}"""
)
def q_sightings_caption(t: Tables) -> DataFrame:
    """One row of numbers about all returned lines."""
    seen = t.lineitem.where(is_seen()).withColumns({"price": money("l_extendedprice"), "yr": ship_year()})
    caption = panel.sightings_caption(seen, "l_suppkey", "yr", ["price"], F.col("l_linestatus") == "O")
    return rounded(rounded(caption, 4, "mean_price"), 6, "confounded_share")


SIGHTINGS_SQL = f"""
seen AS (
  SELECT l_suppkey, s_nationkey, {SHIP_YEAR} AS yr, SUM({amount("l_quantity")}) AS n_seen
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE {SEEN_SQL} GROUP BY ALL
)"""


def supplier_sightings(t: Tables) -> DataFrame:
    """Counted per supplier before the join, so a large supplier is one row a year in it."""
    lines = t.lineitem.withColumn("quantity", money("l_quantity"))
    counted = panel.sightings(lines, ["l_suppkey"], ship_year(), is_seen(), "quantity")
    places = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return counted.join(places, "l_suppkey").select("l_suppkey", "s_nationkey", "yr", "n_seen")


@query(f"WITH {SIGHTINGS_SQL} SELECT l_suppkey, s_nationkey, yr, CAST(n_seen AS DOUBLE) AS n_seen FROM seen")
def q_sightings(t: Tables) -> DataFrame:
    """Returned quantity per supplier, nation and year."""
    return doubles(supplier_sightings(t), "n_seen")


@query(
    f"""WITH {SIGHTINGS_SQL}
SELECT y.yr, CAST(COALESCE(n.place // 7, 0) AS INTEGER) AS part, COALESCE(string_agg(n.id, ', ' ORDER BY n.id), '') AS ids
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INT) - 1 AS yr FROM orders) y
LEFT JOIN (SELECT yr, id, row_number() OVER (PARTITION BY yr ORDER BY id) - 1 AS place
           FROM (SELECT yr, CAST(l_suppkey AS VARCHAR) AS id FROM seen)) n ON n.yr = y.yr
GROUP BY 1, 2"""
)
def q_ids_by_year(t: Tables) -> DataFrame:
    """The suppliers behind each year's sightings as text, seven to a part, for given years."""
    seen = supplier_sightings(t).withColumn("l_suppkey", F.col("l_suppkey").cast("string"))
    years = t.orders.select((F.year("o_orderdate") - 1).alias("yr")).distinct()
    return stats.listed_for(years, stats.ids_by_group(seen, "yr", "l_suppkey", ids_per_part=7), "yr")


@query(
    f"""WITH {SIGHTINGS_SQL}
SELECT l_suppkey, yr, {r("14 + sqrt(greatest(CAST(n_seen AS DOUBLE), 0)) / sqrt((SELECT MAX(CAST(n_seen AS DOUBLE)) FROM seen)) * 34", 4)} AS marker_size
FROM seen"""
)
def q_marker_scale(t: Tables) -> DataFrame:
    """Marker size by the square root of the sightings, relative to the largest."""
    sized = stats.marker_sizes(supplier_sightings(t), "n_seen", 14, 34, 8)
    return rounded(sized.select("l_suppkey", "yr", "marker_size"), 4, "marker_size")


@query(f"WITH {SIGHTINGS_SQL} SELECT {r('QUANTILE_CONT(CAST(n_seen AS DOUBLE), 0.9)', 4)} AS colour_cap FROM seen")
def q_colour_cap(t: Tables) -> DataFrame:
    """90th percentile of the sightings."""
    return rounded(stats.colour_cap(supplier_sightings(t), "n_seen"), 4, "colour_cap")


@query(
    f"""WITH sites AS (SELECT s_suppkey FROM supplier JOIN nation ON n_nationkey = s_nationkey
  WHERE n_name IN (SELECT n_name FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name IN ('ASIA', 'EUROPE'))),
counts AS (
  SELECT {SHIP_YEAR} AS yr,
         SUM(CASE WHEN l_returnflag = 'R' THEN {amount("l_quantity")} ELSE 0 END) AS returned,
         SUM(CASE WHEN l_returnflag = 'A' THEN {amount("l_quantity")} ELSE 0 END) AS accepted,
         SUM(CASE WHEN l_linestatus LIKE 'O%' THEN {amount("l_quantity")} ELSE 0 END) AS open_lines
  FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM sites) GROUP BY ALL),
cover AS (
  SELECT CAST(year(o_orderdate) AS INT) AS yr,
         CAST(SUM({amount("CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END")}) AS DOUBLE)
         / COUNT(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS urgent_mean
  FROM orders GROUP BY ALL)
SELECT c.yr, CAST(returned AS DOUBLE) AS returned, CAST(accepted AS DOUBLE) AS accepted,
       CAST(open_lines AS DOUBLE) AS open_lines, {r("urgent_mean", 4)} AS urgent_mean
FROM counts c JOIN cover v ON v.yr = c.yr"""
)
def q_yearly_trend_inner(t: Tables) -> DataFrame:
    """Yearly conditional sums at listed sites next to a conditional mean, years in both."""
    regions = panel.site_list(t.spark, ["ASIA", "EUROPE"], "r_name")
    nations = panel.at_sites(t.region, regions, "r_name").join(
        t.nation, F.col("r_regionkey") == F.col("n_regionkey")
    )
    sites = t.supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey")
    )
    counted = t.lineitem.groupBy("l_suppkey", "l_returnflag", "l_linestatus", ship_year().alias("yr")).agg(
        F.sum(money("l_quantity")).alias("quantity")
    )
    lines = panel.at_sites(counted, sites, "l_suppkey")
    sums = panel.conditional_sums(
        "quantity",
        {
            "returned": F.col("l_returnflag") == "R",
            "accepted": F.col("l_returnflag") == "A",
            "open_lines": F.col("l_linestatus").startswith("O"),
        },
    )
    cover = t.orders.withColumn("price", money("o_totalprice"))
    urgent = panel.conditional_mean("price", F.col("o_orderpriority") == "1-URGENT")
    trend = panel.yearly_trend(
        lines, cover, F.col("yr"), F.year("o_orderdate"), sums, urgent.alias("urgent_mean")
    )
    return rounded(doubles(trend, "returned", "accepted", "open_lines"), 4, "urgent_mean")


PANEL_SQL = f"""
bought AS (
  SELECT o_custkey AS site, CAST(year(o_orderdate) AS INT) AS yr,
         SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN {amount("o_totalprice")} ELSE 0 END) AS urgent,
         SUM(CASE WHEN o_orderpriority = '5-LOW' THEN {amount("o_totalprice")} ELSE 0 END) AS low
  FROM orders GROUP BY ALL),
visited AS (
  SELECT user_id AS site, CAST(year(ts) AS INT) AS yr,
         CAST(SUM({amount("CASE WHEN event_type = 'purchase' THEN value END")}) AS DOUBLE)
         / COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchase_mean
  FROM events GROUP BY ALL),
shipped AS (
  SELECT o_custkey AS site, {SHIP_YEAR} AS yr, COUNT(DISTINCT l_partkey) AS richness,
         SUM({amount("l_extendedprice")}) AS biomass, SUM({amount("l_quantity")}) AS total
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL),
keys AS (SELECT site, yr FROM bought UNION SELECT site, yr FROM visited UNION SELECT site, yr FROM shipped),
panel AS (
  SELECT k.site, k.yr, CAST(COALESCE(urgent, 0) AS DOUBLE) AS urgent, CAST(COALESCE(low, 0) AS DOUBLE) AS low,
         {r("purchase_mean", 4)} AS purchase_mean, richness, CAST(biomass AS DOUBLE) AS biomass,
         CAST(total AS DOUBLE) AS total
  FROM keys k LEFT JOIN bought b ON b.site = k.site AND b.yr = k.yr
  LEFT JOIN visited v ON v.site = k.site AND v.yr = k.yr
  LEFT JOIN shipped s ON s.site = k.site AND s.yr = k.yr)"""


def customer_panel(t: Tables, sites: DataFrame | None = None, years: tuple[int, int] = (1, 9999)) -> DataFrame:
    """Customer and year over orders, site visits and shipped lines.

    Customers (``site``) and years can be chosen; what is not wanted goes before anything is
    aggregated.
    """
    wanted = lambda df, site: df if sites is None else df.join(sites.select(F.col("site").alias(site)), site, "left_semi")
    within = lambda df: df.where(F.col("yr").between(*years))
    t_orders = wanted(t.orders, "o_custkey")
    orders = t_orders.withColumn("price", money("o_totalprice"))
    priorities = {
        "urgent": F.col("o_orderpriority") == "1-URGENT",
        "low": F.col("o_orderpriority") == "5-LOW",
    }
    bought = orders.groupBy(
        F.col("o_custkey").alias("site"), F.year("o_orderdate").alias("yr")
    ).agg(*panel.conditional_sums("price", priorities))
    events = wanted(t.events, "user_id").withColumn("value", money("value"))
    purchase = panel.conditional_mean("value", F.col("event_type") == "purchase")
    visited = events.groupBy(F.col("user_id").alias("site"), F.year("ts").alias("yr")).agg(
        purchase.alias("purchase_mean")
    )
    # An order with very many lines is split by Spark's own skew-join handling.
    buyers = t_orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("site"))
    lines = within(t.lineitem.withColumn("yr", ship_year())).join(buyers, "l_orderkey")
    shipped = lines.groupBy("site", "yr").agg(
        F.count_distinct("l_partkey").alias("richness"),
        F.sum(money("l_extendedprice")).alias("biomass"),
        F.sum(money("l_quantity")).alias("total"),
    )
    joined = panel.anchored_panel([within(bought), within(visited), shipped], ["site", "yr"], ["urgent", "low"])
    return rounded(doubles(joined, "urgent", "low", "biomass", "total"), 4, "purchase_mean")


@query(f"WITH {PANEL_SQL} SELECT * FROM panel")
def q_site_year_panel(t: Tables) -> DataFrame:
    """One row per customer and year present in any of three sources."""
    return customer_panel(t)


@query("SELECT user_id AS site, CAST(year(ts) AS INT) AS yr FROM events UNION SELECT o_custkey, CAST(year(o_orderdate) AS INT) FROM orders")
def q_union_keys(t: Tables) -> DataFrame:
    """Distinct customer years from two sources."""
    events = t.events.select(F.col("user_id").alias("site"), F.year("ts").alias("yr"))
    orders = t.orders.select(F.col("o_custkey").alias("site"), F.year("o_orderdate").alias("yr"))
    return union_keys([events, orders], ["site", "yr"])


LAG_SQL = """
yearly AS (
  SELECT o_custkey AS site, CAST(year(o_orderdate) AS INT) AS yr,
         SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS urgent,
         SUM(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS low
  FROM orders GROUP BY ALL),
lagged AS (SELECT *, LAG(urgent) OVER (PARTITION BY site ORDER BY yr) AS urgent_prev FROM yearly),
tiered AS (
  SELECT *, CASE WHEN urgent_prev <= 0 THEN 'none' WHEN urgent_prev <= 1 THEN 'low'
                 WHEN urgent_prev <= 2 THEN 'medium' ELSE 'high' END AS tier
  FROM lagged WHERE urgent_prev IS NOT NULL)"""
TIERS = ["none", "low", "medium", "high", "extreme"]


def lagged_orders(t: Tables) -> DataFrame:
    one = t.orders.withColumn("one", F.lit(1))
    sums = panel.conditional_sums(
        "one",
        {
            "urgent": F.col("o_orderpriority") == "1-URGENT",
            "low": F.col("o_orderpriority") == "5-LOW",
        },
    )
    yearly = one.groupBy(F.col("o_custkey").alias("site"), F.year("o_orderdate").alias("yr")).agg(*sums)
    return panel.previous_year_value(yearly, "site", "yr", "urgent", "urgent_prev")


def tiered_orders(t: Tables) -> DataFrame:
    tier = ordered_tier(F.col("urgent_prev"), [0, 1, 2], TIERS[:4])
    return lagged_orders(t).dropna(subset=["urgent_prev"]).withColumn("tier", tier)


@query(
    f"""WITH {LAG_SQL}
SELECT site, yr, CAST(urgent AS BIGINT) AS urgent, CAST(low AS BIGINT) AS low,
       CAST(urgent_prev AS BIGINT) AS urgent_prev, tier FROM tiered"""
)
def q_lag_predictor(t: Tables) -> DataFrame:
    """Orders of this year next to the previous ordering year's urgent orders, in tiers."""
    return tiered_orders(t)


@query(
    f"""WITH {LAG_SQL}, tiers(tier_no, tier) AS (VALUES (0, 'none'), (1, 'low'), (2, 'medium'), (3, 'high'), (4, 'extreme'))
SELECT tier_no, tiers.tier, {r("CAST(SUM(low) AS DOUBLE) / COUNT(low)", 6)} AS mean_value
FROM tiers LEFT JOIN tiered ON tiered.tier = tiers.tier GROUP BY ALL"""
)
def q_tier_means(t: Tables) -> DataFrame:
    """Mean of the response per tier in order, a tier without rows kept."""
    return rounded(stats.tier_means(tiered_orders(t), "tier", "low", TIERS), 6, "mean_value")


@query(
    f"""WITH orders_tiered AS (
  SELECT CASE WHEN o_totalprice <= 50000 THEN 'none' WHEN o_totalprice <= 150000 THEN 'low'
              WHEN o_totalprice <= 300000 THEN 'medium' ELSE 'high' END AS tier, o_custkey FROM orders)
SELECT tier, CAST(MIN(o_custkey) AS DOUBLE) AS low, {r("QUANTILE_CONT(CAST(o_custkey AS DOUBLE), 0.25)", 4)} AS q1,
       {r("QUANTILE_CONT(CAST(o_custkey AS DOUBLE), 0.5)", 4)} AS median,
       {r("QUANTILE_CONT(CAST(o_custkey AS DOUBLE), 0.75)", 4)} AS q3,
       CAST(MAX(o_custkey) AS DOUBLE) AS high, COUNT(*) AS n_rows,
       {r("CAST(SUM(o_custkey) AS DOUBLE) / COUNT(*)", 4)} AS mean_value
FROM orders_tiered GROUP BY tier"""
)
def q_tier_boxes(t: Tables) -> DataFrame:
    """Five-number summary and mean per price tier over all orders."""
    tier = ordered_tier(F.col("o_totalprice"), [50000, 150000, 300000], TIERS[:4])
    tiered = t.orders.select(tier.alias("tier"), "o_custkey")
    return rounded(stats.tier_boxes(tiered, "tier", "o_custkey"), 4, "q1", "median", "q3", "mean_value")


@query(
    f"""WITH {PANEL_SQL}
SELECT {r("CORR(urgent, biomass)", 6)} AS urgent_biomass, {r("CORR(low, CAST(richness AS DOUBLE))", 6)} AS low_richness
FROM panel"""
)
def q_correlations(t: Tables) -> DataFrame:
    """Correlations over the customer-year panel, pairwise complete."""
    found = stats.correlations(
        customer_panel(t),
        {"urgent_biomass": ("urgent", "biomass"), "low_richness": ("low", "richness")},
    )
    return rounded(found, 6, "urgent_biomass", "low_richness")


BRAND_SQL = f"""
yearly AS (
  SELECT p_brand, {SHIP_YEAR} AS yr, SUM({amount("l_quantity")}) AS total_count
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
trends AS (
  SELECT p_brand, REGR_SLOPE(CAST(total_count AS DOUBLE), CAST(yr AS DOUBLE)) AS trend_per_year,
         COUNT(*) AS years_observed, MIN(yr) AS first_year, MAX(yr) AS last_year,
         ARG_MIN(total_count, yr) AS first_count, ARG_MAX(total_count, yr) AS last_count
  FROM yearly GROUP BY p_brand HAVING COUNT(*) >= 5)"""


def brand_trends(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("quantity", money("l_quantity"))
    per_part = panel.yearly_totals(lines, "l_partkey", ship_year(), "quantity")
    branded = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    yearly = panel.yearly_totals(branded, "p_brand", F.col("yr"), "total_count")
    return panel.entity_trends(yearly, "p_brand", 5)


@query(
    f"""WITH {BRAND_SQL},
picked AS (
  (SELECT * FROM trends ORDER BY {r("trend_per_year", 6)} DESC NULLS FIRST, p_brand LIMIT 10)
  UNION
  (SELECT * FROM trends ORDER BY {r("trend_per_year", 6)} ASC NULLS LAST, p_brand DESC LIMIT 10))
SELECT k.p_brand, {r("trend_per_year", 6)} AS trend_per_year, years_observed, first_year, last_year,
       CAST(first_count AS DOUBLE) AS first_count, CAST(last_count AS DOUBLE) AS last_count,
       CASE WHEN n.common_name IS NOT NULL THEN n.common_name || ' (' || k.p_brand || ')' ELSE k.p_brand END AS label
FROM picked k LEFT JOIN (SELECT p_brand, MIN(p_name) AS common_name FROM part WHERE p_size > 49 AND p_type = 'SMALL' GROUP BY p_brand) n
  ON n.p_brand = k.p_brand"""
)
def q_entity_trend_topk(t: Tables) -> DataFrame:
    """The ten strongest rises and falls in yearly quantity per brand, labelled."""
    trends = doubles(rounded(brand_trends(t), 6, "trend_per_year"), "first_count", "last_count")
    names = t.part.where((F.col("p_size") > 49) & (F.col("p_type") == "SMALL"))
    names = names.groupBy("p_brand").agg(F.min("p_name").alias("common_name"))
    ranked = stats.extremes(trends, "trend_per_year", 10, "p_brand").join(names, "p_brand", "left")
    label = display_label(F.col("p_brand"), F.col("common_name"))
    return ranked.withColumn("label", label).drop("common_name")


@query(
    f"""WITH yearly AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS yr, SUM({amount("o_totalprice")}) AS total_count
  FROM orders GROUP BY ALL)
SELECT o_custkey, yr, CAST(total_count AS DOUBLE) AS total_count FROM yearly
WHERE o_custkey IN (SELECT o_custkey FROM yearly GROUP BY o_custkey HAVING COUNT(*) >= 6)"""
)
def q_support_series(t: Tables) -> DataFrame:
    """Yearly totals of customers seen in at least six years."""
    priced = t.orders.withColumn("price", money("o_totalprice"))
    yearly = panel.yearly_totals(priced, "o_custkey", F.year("o_orderdate"), "price")
    return doubles(panel.supported_series(yearly, "o_custkey", 6), "total_count")


@query(
    f"""WITH yearly AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS yr, SUM({amount("o_totalprice")}) AS total_count
  FROM orders GROUP BY ALL),
spans AS (SELECT o_custkey, MIN(yr) AS a, MAX(yr) AS b FROM yearly GROUP BY o_custkey),
frame AS (SELECT o_custkey, CAST(UNNEST(generate_series(a, b)) AS INT) AS yr FROM spans)
SELECT f.o_custkey, f.yr, CAST(y.total_count AS DOUBLE) AS total_count
FROM frame f LEFT JOIN yearly y ON y.o_custkey = f.o_custkey AND y.yr = f.yr"""
)
def q_densify_years(t: Tables) -> DataFrame:
    """Every year between a customer's first and last order year, gaps without a total."""
    priced = t.orders.withColumn("price", money("o_totalprice"))
    yearly = panel.yearly_totals(priced, "o_custkey", F.year("o_orderdate"), "price")
    return doubles(panel.densify_years(yearly, "yr", ["o_custkey"]), "total_count")


@query(
    """WITH lines AS (
  SELECT o.o_custkey % 7 AS region, CAST(year(l.l_shipdate) AS INT) AS yr, l.l_partkey
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
),
spans AS (SELECT * FROM (VALUES ('early', 1990, 1995), ('late', 1996, 2005), ('all', 1990, 2005)) AS s(span, first_year, last_year))
SELECT span, region, COUNT(DISTINCT l_partkey) AS richness, TRUE AS near
FROM lines JOIN spans ON yr BETWEEN first_year AND last_year GROUP BY span, region"""
)
def q_richness_sketch(t: Tables) -> DataFrame:
    """Distinct parts per region and span of years: counted, and whether united sketches come within 5 %.

    Sketches are kept per region and year; the spans overlap, each is a union of them.
    """
    buyers = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 7).alias("region"))
    lines = t.lineitem.join(buyers, "l_orderkey").select("region", ship_year().alias("yr"), "l_partkey")
    spans = F.explode(F.array(*[
        F.struct(F.lit(name).alias("span"), F.lit(low).alias("low"), F.lit(high).alias("high"))
        for name, low, high in (("early", 1990, 1995), ("late", 1996, 2005), ("all", 1990, 2005))
    ]))

    def by_span(df: DataFrame) -> DataFrame:
        return df.withColumn("s", spans).where(F.col("yr").between(F.col("s.low"), F.col("s.high"))).withColumn("span", F.col("s.span"))

    sketches = stored(panel.distinct_sketches(lines, ["region", "yr"], "l_partkey"), "richness-sketches")
    estimated = panel.united_distinct(by_span(sketches), ["span", "region"], "estimate")
    counted = by_span(lines.distinct()).groupBy("span", "region").agg(F.count_distinct("l_partkey").alias("richness"))
    near = F.abs(F.col("estimate") - F.col("richness")) <= 0.05 * F.col("richness")
    return counted.join(estimated, ["span", "region"]).select("span", "region", "richness", near.alias("near"))

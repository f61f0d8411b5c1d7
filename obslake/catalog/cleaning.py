"""Parsing, flags, structural cleaning and HTML tables over text made from the tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.catalog.registry import Tables, query, r, rounded
from obslake.functions.text import (
    MONTH_NAMES, clean_text, has_repeated_dots, kilograms_to_tonnes, month_start, to_number,
)
from obslake.operators.cleaning import (
    dropped_for_keys, mark_parsed, shallow, structurally_sound, with_required,
)
from obslake.plans import season_catch
from obslake.session import spread, stored
from obslake.sources.html_tables import html_tables


def month_name(date: str) -> Column:
    names = F.array(*[F.lit(m.capitalize()) for m in MONTH_NAMES])
    return names[F.month(date) - 1]


def messy_price(price: str) -> Column:
    """Commas for open orders, doubled dots for final ones, blank for pending ones."""
    formatted = F.format_number(price, 2)
    return (
        F.when(F.col("o_orderpriority") == "5-LOW", "n/a")
        .when(F.col("o_orderstatus") == "O", formatted)
        .when(F.col("o_orderstatus") == "F", F.replace(formatted, F.lit("."), F.lit("..")))
        .otherwise("")
    )


@query(
    """SELECT o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus = 'P' THEN NULL ELSE round(o_totalprice, 2) END AS price,
       o_orderpriority <> '5-LOW' AND o_orderstatus = 'F' AS had_typo
FROM orders"""
)
def q_number_parse(t: Tables) -> DataFrame:
    """Prices read back from text with commas, doubled dots, blanks and words."""
    text = t.orders.select("o_orderkey", messy_price("o_totalprice").alias("raw"))
    return text.select(
        "o_orderkey", to_number(F.col("raw")).alias("price"), has_repeated_dots(F.col("raw")).alias("had_typo")
    )


@query(
    """SELECT o_orderkey, o_orderstatus <> 'P' AS parsed,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS month_date
FROM orders"""
)
def q_month_parse(t: Tables) -> DataFrame:
    """Month labels in several spellings; those of pending orders do not parse."""
    year = F.year("o_orderdate").cast("string")
    label = (
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("Q4 "), year))
        .when(F.col("o_orderstatus") == "F", F.concat(F.upper(month_name("o_orderdate")), F.lit("  "), year))
        .otherwise(F.concat(month_name("o_orderdate"), F.lit(" "), year, F.lit(" (final)")))
    )
    dated = t.orders.select("o_orderkey", month_start(label).alias("month_date"))
    return mark_parsed(dated, "month_date", "parsed")


BLANKS = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1C}-\x{1F}]+"


@query(
    f"""SELECT doc_id, 'office 1' || chr(8260) || '2 Quota 2007 ' || trim(regexp_replace(
       replace(replace('*' || text || chr(8203) || ' *', chr(8203), ''), '*', ''), '{BLANKS}', ' ', 'g')) AS cleaned
FROM documents"""
)
def q_text_clean(t: Tables) -> DataFrame:
    """Whole documents normalised, without zero-width marks, asterisks and odd blanks.

    Each begins with a ligature, a fraction and full-width letters and digits.
    """
    forms = F.lit("o\ufb03ce \u00bd \uff31\uff55\uff4f\uff54\uff41 \uff12\uff10\uff10\uff17 *")
    marked = F.concat(forms, "text", F.lit("\u200b"), F.lit(" *"))
    return t.documents.select("doc_id", clean_text(marked).alias("cleaned"))


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
       {r("CASE WHEN l_linestatus = 'F' THEN l_quantity / 1000 ELSE l_quantity END", 4)} AS tonnes,
       l_quantity - 40 < 0 AS flag_over,
       {r("l_tax", 4)} AS tax, l_tax > 0.05 AS flag_tax, l_tax > 0.05 OR l_quantity - 40 < 0 AS any_flag
FROM lineitem"""
)
def q_unit_flags(t: Tables) -> DataFrame:
    """Quantities brought to one unit, row flags and their disjunction."""
    unit = F.when(F.col("l_linestatus") == "F", "KG").otherwise("tonnes")
    flags = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        kilograms_to_tonnes(F.col("l_quantity"), unit).alias("tonnes"),
        F.coalesce(F.col("l_quantity") - 40 < 0, F.lit(False)).alias("flag_over"),
        F.col("l_tax").alias("tax"),
        F.coalesce(F.col("l_tax") > 0.05, F.lit(False)).alias("flag_tax"),
    )
    flagged = flags.withColumn("any_flag", F.col("flag_tax") | F.col("flag_over"))
    return rounded(flagged, 4, "tonnes", "tax")


JOINED_SQL = """
visits AS (
  SELECT e.event_id, e.user_id, e.value, c.c_acctbal, c.c_nationkey, c.c_mktsegment
  FROM events e LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 1000) c ON c.c_custkey = e.user_id)"""


def visits(t: Tables) -> DataFrame:
    """Events with their customer where the balance is known to be good; NULLs elsewhere."""
    known = t.customer.where("c_acctbal > 1000")
    joined = t.events.join(known, F.col("user_id") == F.col("c_custkey"), "left")
    return joined.select("event_id", "user_id", "value", "c_acctbal", "c_nationkey", "c_mktsegment")


@query(
    f"""WITH {JOINED_SQL} SELECT * FROM visits WHERE c_mktsegment = 'BUILDING' AND c_nationkey IS NOT NULL
  AND value - 5 >= 0 AND (c_acctbal IS NULL OR c_acctbal - 2000 >= 0)"""
)
def q_structural_clean(t: Tables) -> DataFrame:
    """Rows of one segment with a known place and measures that are not negative."""
    shifted = visits(t).withColumns({"over": F.col("value") - 5, "spare": F.col("c_acctbal") - 2000})
    sound = structurally_sound(("c_mktsegment", "BUILDING"), ["c_nationkey"], ["over"], ["spare"])
    return shifted.where(sound).drop("over", "spare")


@query(f"WITH {JOINED_SQL} SELECT * FROM visits WHERE COALESCE(c_acctbal, 0) <= 3000")
def q_surface_cut(t: Tables) -> DataFrame:
    """Rows up to a limit, where a missing depth counts as surface."""
    return visits(t).where(shallow("c_acctbal", 3000))


@query(f"WITH {JOINED_SQL} SELECT * FROM visits WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL")
def q_required_keys(t: Tables) -> DataFrame:
    """Rows that have all required keys."""
    return with_required(visits(t), ["event_id", "c_nationkey", "c_mktsegment"])


@query(
    f"""WITH {JOINED_SQL} SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE event_id IS NULL OR c_nationkey IS NULL OR c_mktsegment IS NULL) AS n_dropped FROM visits"""
)
def q_dropped_for_keys(t: Tables) -> DataFrame:
    """How many rows a required key costs."""
    return dropped_for_keys(visits(t), ["event_id", "c_nationkey", "c_mktsegment"])


@query(
    """SELECT page_id, 0 AS table_no, 0 AS row_no, 'Page|Address|Length' AS cells FROM pages
UNION ALL
SELECT page_id, 0, 1, CAST(page_id AS VARCHAR) || '|' || trim(regexp_replace(replace(url, '*', ''), '\\s+', ' ', 'g'))
       || '|' || CAST(length(html) AS VARCHAR) FROM pages"""
)
def q_html_tables(t: Tables) -> DataFrame:
    """Cells of a table put in front of every page, out of the whole page."""
    table = F.concat(
        F.lit("<div><table class=x><tr><th>​**Page**<th>Address</th><th>Length&nbsp;</tr><tr></tr>"),
        F.lit("<TR><td> "), F.col("page_id").cast("string"), F.lit("<td><a href='#'>"),
        F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</a></td><td><b>"),
        F.length("html").cast("string"), F.lit("</b></td></TR></table></div>"),
    )
    pages = stored(spread(t.pages).select("page_id", F.concat(table, "html").alias("html")), "pages")
    found = html_tables(pages, ["page_id"], "html")
    rows = found.select("page_id", "table_no", F.posexplode("rows").alias("row_no", "row"))
    return rows.select("page_id", "table_no", "row_no", F.array_join("row", "|").alias("cells"))


def season_pages(t: Tables) -> DataFrame:
    """One page per order with a season table: a month row and a total row."""
    year, kg = F.year("o_orderdate"), F.col("o_orderstatus") == "F"
    season = F.concat(year.cast("string"), F.lit("/"), F.lpad(F.pmod(year + 1, F.lit(100)).cast("string"), 2, "0"))
    price = messy_price("o_totalprice")
    share = F.format_number(F.col("o_totalprice") / 1523.5, 2)
    width = F.col("o_orderpriority") == "1-URGENT"
    html = F.concat(
        F.lit("<html><body><p>x</p><table><tr><th>​**Quota Year "), season,
        F.lit("** TAC 1,523.5 t​onnes</th><th>Total "), F.when(kg, "(kg)").otherwise("tonnes"),
        F.lit(" caught</th>"), F.when(width, "<th>Uncaught").otherwise(""), F.lit("<th>% taken</tr><tr><td>​"),
        month_name("o_orderdate"), F.lit(" "), year.cast("string"), F.lit("</td><td>"), price, F.lit("</td>"),
        F.when(width, "<td>-12..50</td>").otherwise(""), F.lit("<td>"), share,
        F.lit("</td></tr><tr><td>**TOTAL**</td><td><b>"), F.format_number("o_totalprice", 2),
        F.lit("</b></td></tr></table><table><tr><td>no season</td></tr></table></body></html>"),
    )
    # Written down: else the filter on pages with a table would make every page once more.
    pages = spread(t.orders).select(
        F.col("o_orderkey").alias("page_id"), F.lit("orders").alias("url"), html.alias("html")
    )
    return stored(pages, "pages")


SEASON_SQL = f"""
parsed AS (
  SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_date,
         CASE WHEN o_orderstatus = 'F' THEN 1000 ELSE 1 END AS unit, o_orderpriority = '1-URGENT' AS wide,
         CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price,
         CAST(ROUND(CAST(o_totalprice / 1523.5 AS DECIMAL(28,10)), 2) AS DOUBLE) AS share, o_totalprice,
         o_orderpriority <> '5-LOW' AND o_orderstatus = 'F' AS typo
  FROM orders),
months AS (
  SELECT *, y || '/' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS season, price / unit AS catch_tonnes,
         CASE WHEN wide THEN -12.5 / unit END AS uncaught FROM parsed),
flagged AS (
  SELECT *, {r("catch_tonnes / 1523.5 * 100", 1)} AS computed FROM months)"""


@query(
    f"""WITH {SEASON_SQL}
SELECT season AS quota_year, month_date, 1523.5::DOUBLE AS tac_tonnes, {r("catch_tonnes", 6)} AS catch_tonnes,
       {r("uncaught", 6)} AS uncaught_tonnes, share AS pct_tac_taken_scraped, computed AS pct_tac_taken_computed,
       wide AS flag_over_quota, catch_tonnes IS NULL AS flag_not_yet_reported,
       COALESCE(ABS(computed - share) > 0.5, FALSE) AS flag_pct_mismatch, typo AS catch_had_typo,
       wide AS uncaught_had_typo,
       typo OR wide OR COALESCE(ABS(computed - share) > 0.5, FALSE) AS any_flag
FROM flagged"""
)
def q_season_pages(t: Tables) -> DataFrame:
    """Season tables on one page per order, through to clean flagged months."""
    raw = season_catch.raw_records(season_pages(t), datetime(2024, 2, 1))
    clean, _ = season_catch.clean_months(raw)
    return rounded(clean.drop("source_url", "scraped_at"), 6, "catch_tonnes", "uncaught_tonnes")


@query(
    f"""WITH {SEASON_SQL}
SELECT season AS quota_year, COUNT(*) AS n_pages, {r("SUM(CAST(o_totalprice / unit AS DECIMAL(28,6)))", 4)} AS published,
       {r("SUM(CAST(catch_tonnes AS DECIMAL(28,6)))", 4)} AS reported
FROM flagged GROUP BY season"""
)
def q_season_totals(t: Tables) -> DataFrame:
    """Published totals and reported months per season, from the same stored records."""
    raw = stored(season_catch.raw_records(season_pages(t), datetime(2024, 2, 1)), "records")
    exact = "decimal(28,6)"
    published = season_catch.published_totals(raw).groupBy("quota_year").agg(
        F.count(F.lit(1)).alias("n_pages"), F.sum(F.col("catch_tonnes_published").cast(exact)).alias("published")
    )
    clean, _ = season_catch.clean_months(raw)
    months = clean.groupBy("quota_year").agg(F.sum(F.col("catch_tonnes").cast(exact)).alias("reported"))
    return rounded(published.join(months, "quota_year", "left"), 4, "published", "reported")

"""Seasonal catch against a yearly allowance, from published HTML tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.functions.numbers import half_even
from obslake.functions.text import (
    has_repeated_dots, is_true_text, kilograms_to_tonnes, month_start, to_number,
)
from obslake.operators import keys, quality, series
from obslake.operators.cleaning import split_rejects
from obslake.sources import tables
from obslake.sources.html_tables import html_tables, season_records

PERCENT_TOLERANCE = 0.5
RECONCILE_TOLERANCE = 0.5


def raw_records(pages: DataFrame, scraped_at: datetime) -> DataFrame:
    """Text records of every season table on every page, with provenance."""
    key = ["page_id", "url"]
    records = season_records(html_tables(pages.select(*key, "html"), key, "html"), key)
    stamp = F.lit(scraped_at.strftime("%Y-%m-%dT%H:%M:%SZ"))
    return records.withColumn("scraped_at", stamp).withColumnRenamed("url", "source_url")


def clean_months(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed monthly rows with flags, and the rows whose month label will not parse."""
    monthly = raw.where(~is_true_text(F.col("is_total_row")))
    dated = monthly.withColumn("month_date", month_start(F.col("row_label")))
    parsed, rejects = split_rejects(dated, "month_date")
    numbers = parsed.withColumns(
        {
            "catch_had_typo": has_repeated_dots(F.col("catch_raw")),
            "uncaught_had_typo": has_repeated_dots(F.col("uncaught_raw")),
            "tac_tonnes": to_number(F.col("tac_tonnes_raw")),
            "catch_tonnes": _tonnes("catch_raw"),
            "uncaught_tonnes": _tonnes("uncaught_raw"),
            "pct_tac_taken_scraped": to_number(F.col("pct_tac_taken_raw")),
        }
    )
    computed = half_even(F.try_divide(F.col("catch_tonnes"), F.col("tac_tonnes")) * 100, 1)
    gap = F.abs(F.col("pct_tac_taken_computed") - F.col("pct_tac_taken_scraped"))
    flagged = numbers.withColumn("pct_tac_taken_computed", computed).withColumns(
        {
            "flag_over_quota": F.coalesce(F.col("uncaught_tonnes") < 0, F.lit(False)),
            "flag_not_yet_reported": F.col("catch_tonnes").isNull(),
            "flag_pct_mismatch": F.coalesce(gap > PERCENT_TOLERANCE, F.lit(False)),
        }
    )
    # A month without a report is normal and does not count as a flagged row.
    any_flag = (
        F.col("catch_had_typo") | F.col("uncaught_had_typo")
        | F.col("flag_over_quota") | F.col("flag_pct_mismatch")
    )
    clean = flagged.withColumn("any_flag", any_flag).select(
        "quota_year", "month_date", "tac_tonnes", "catch_tonnes", "uncaught_tonnes",
        "pct_tac_taken_scraped", "pct_tac_taken_computed", "flag_over_quota",
        "flag_not_yet_reported", "flag_pct_mismatch", "catch_had_typo",
        "uncaught_had_typo", "any_flag", "source_url", "scraped_at",
    )
    return clean, rejects.select("quota_year", "row_label")


def _tonnes(raw: str) -> Column:
    unit = F.coalesce(F.col("catch_unit_raw"), F.lit("tonnes"))
    return kilograms_to_tonnes(to_number(F.col(raw)), unit)


def published_totals(raw: DataFrame) -> DataFrame:
    """The season totals the source itself states."""
    totals = raw.where(is_true_text(F.col("is_total_row")))
    return totals.select("quota_year", _tonnes("catch_raw").alias("catch_tonnes_published"))


def reconciliation(clean: DataFrame, totals: DataFrame) -> DataFrame:
    """Monthly sums next to the published totals, every season."""
    sums = clean.groupBy("quota_year").agg(F.sum("catch_tonnes").alias("catch_tonnes_summed"))
    return quality.reconciliation_report(
        totals, sums, ["quota_year"], "catch_tonnes_published", "catch_tonnes_summed",
        RECONCILE_TOLERANCE,
    ).withColumnRenamed("diff", "diff_tonnes")


def star_schema(clean: DataFrame, totals: DataFrame) -> dict[str, DataFrame]:
    """Season dimension, monthly fact and published totals, in their stored types."""
    tac = F.col("tac_tonnes").cast("decimal(10,2)").alias("tac_tonnes")
    fact = clean.select(
        "quota_year",
        "month_date",
        F.col("catch_tonnes").cast("decimal(10,4)").alias("catch_tonnes"),
        F.col("uncaught_tonnes").cast("decimal(12,4)").alias("uncaught_tonnes"),
        F.col("pct_tac_taken_scraped").cast("decimal(6,2)").alias("pct_tac_taken_scraped"),
        F.col("pct_tac_taken_computed").cast("decimal(6,2)").alias("pct_tac_taken_computed"),
        "flag_over_quota", "flag_not_yet_reported", "flag_pct_mismatch", "any_flag",
        "source_url", F.col("scraped_at").cast("timestamp").alias("scraped_at"),
    )
    published = F.col("catch_tonnes_published").cast("decimal(10,2)")
    return {
        "dim_season": keys.distinct_pairs(clean.select("quota_year", tac), ["quota_year", "tac_tonnes"]),
        "fact_catch": fact,
        "qa_totals": totals.select("quota_year", published.alias("catch_tonnes_published")),
    }


def constraints(star: dict[str, DataFrame]) -> DataFrame:
    """Violations of the star schema's rules; all zero before loading."""
    dim, fact, totals = star["dim_season"], star["fact_catch"], star["qa_totals"]
    report = quality.constraint_report(
        fact,
        {
            "season present": F.col("quota_year").isNotNull(),
            "month present": F.col("month_date").isNotNull(),
            "catch not negative": F.col("catch_tonnes") >= 0,
        },
        unique={"one row per season and month": ["quota_year", "month_date"]},
        references={"season known": (dim, ["quota_year"])},
    )
    allowance = quality.rule_violations(dim, {"allowance present": F.col("tac_tonnes").isNotNull()})
    one_allowance = quality.unique_violations(dim, "one allowance per season", ["quota_year"])
    one_total = quality.unique_violations(totals, "one total per season", ["quota_year"])
    return report.unionByName(allowance).unionByName(one_allowance).unionByName(one_total)


def load(star: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Rebuild the three tables, unless a rule is broken; returns name -> path."""
    quality.enforce(star["fact_catch"], constraints(star))
    paths = {name: f"{folder}/{name}" for name in star}
    for name, table in star.items():
        tables.replace_table(table, paths[name])
    return paths


def season_progress(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Season-to-date catch and the share of the allowance it takes."""
    progress = series.running_progress(
        fact, dim, "quota_year", "month_date", "catch_tonnes", "tac_tonnes"
    )
    return progress.select(
        "quota_year", "month_date", "catch_tonnes",
        F.col("cumulative").alias("cumulative_catch_tonnes"), "tac_tonnes",
        F.col("cumulative_pct").alias("cumulative_pct_tac"),
    )


def month_over_month(fact: DataFrame) -> DataFrame:
    """Change from the previous reported month, across all seasons."""
    return series.period_change(
        fact.select("quota_year", "month_date", "catch_tonnes"), "month_date", "catch_tonnes"
    ).withColumnsRenamed({"previous": "prev_period_catch_tonnes", "change": "change_tonnes"})


def unreconciled(fact: DataFrame, totals: DataFrame) -> DataFrame:
    """Seasons whose reported months do not add up to the published total."""
    sums = fact.groupBy("quota_year").agg(F.sum("catch_tonnes").alias("summed_tonnes"))
    return quality.reconciliation_exceptions(
        sums, totals, ["quota_year"], "summed_tonnes", "catch_tonnes_published",
        RECONCILE_TOLERANCE,
    ).withColumnRenamed("diff", "diff_tonnes")


def flagged_rows(fact: DataFrame) -> DataFrame:
    return fact.where("any_flag").select(
        "quota_year", "month_date", "catch_tonnes", "uncaught_tonnes",
        "flag_over_quota", "flag_pct_mismatch", "any_flag",
    )


def run_summary(clean: DataFrame) -> DataFrame:
    """What a cleaning run reports: rows, seasons and flagged rows."""
    return clean.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("quota_year").alias("n_seasons"),
        F.count_if("any_flag").alias("n_flagged"),
        F.count_if("flag_not_yet_reported").alias("n_not_yet_reported"),
    )


def export_tables(fact: DataFrame, dim: DataFrame) -> dict[str, DataFrame]:
    """The named results handed to dashboards as flat files."""
    return {
        "season_progress": season_progress(fact, dim).orderBy("quota_year", "month_date"),
        "month_over_month": month_over_month(fact).orderBy("month_date"),
        "flagged_rows": flagged_rows(fact).orderBy("quota_year", "month_date"),
    }

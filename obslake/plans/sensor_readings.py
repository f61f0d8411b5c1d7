"""High-rate sensor readings: staging, star schema, flags, daily climatology, gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions.numbers import half_up
from obslake.operators import keys, quality, series
from obslake.operators.cleaning import plausible, typed
from obslake.operators.ordered import Ranges
from obslake.schemas import SENSOR_TYPES
from obslake.session import stored
from obslake.sources import tables
from obslake.sources.delimited import require_columns

BOUNDS = {"temp_c": (0.0, 30.0), "psal": (0.0, 40.0)}
NATURAL_KEY = ["deployment_code", "nominal_depth_m", "timestamp"]
DEPLOYMENT = ["deployment_code", "nominal_depth_m"]
GOOD_QC = (1, 2)
BAD_QC = (3, 4)


def clean_readings(staged: DataFrame) -> DataFrame:
    """Typed, plausible readings, one per deployment, depth and time.

    A reading without salinity is not plausible and is left out, although the fact
    table would allow it.
    """
    require_columns(staged, [source for source, _ in SENSOR_TYPES.values()])
    kept = typed(staged, SENSOR_TYPES).where(plausible(BOUNDS))
    return keys.keep_first(kept, NATURAL_KEY)


def clean_summary(staged: DataFrame, clean: DataFrame) -> DataFrame:
    """Rows before and after, and what the clean rows cover."""
    before = staged.agg(F.count(F.lit(1))).scalar()
    in_bounds = typed(staged, SENSOR_TYPES).where(plausible(BOUNDS))
    return clean.agg(
        F.count(F.lit(1)).alias("n_clean"),
        F.min("timestamp").alias("earliest"),
        F.max("timestamp").alias("latest"),
        F.count_distinct("deployment_code").alias("n_deployments"),
        F.count_distinct("nominal_depth_m").alias("n_depths"),
    ).withColumns({"n_before": before, "n_plausible": in_bounds.agg(F.count(F.lit(1))).scalar()})


def deployments(clean: DataFrame) -> DataFrame:
    """The deployment dimension with dense ids in natural-key order."""
    spans = keys.derive_dimension(
        clean, DEPLOYMENT, "timestamp", "deployment_start", "deployment_end"
    )
    return keys.number_rows(spans, DEPLOYMENT, "deployment_id")


def readings(clean: DataFrame, dim: DataFrame) -> DataFrame:
    """The reading fact in its stored types, keyed by deployment and time."""
    resolved = keys.resolve_key(clean, dim, DEPLOYMENT, "deployment_id")
    return resolved.select(
        "deployment_id",
        "timestamp",
        F.col("depth_m").cast("decimal(6,3)").alias("depth_m"),
        "depth_qc",
        F.col("temp_c").cast("decimal(5,2)").alias("temp_c"),
        "temp_qc",
        F.col("psal").cast("decimal(6,3)").alias("psal"),
        "psal_qc",
    )


def load(
    staged: DataFrame, folder: str, source_file: str, started_at: datetime, finished_at: datetime
) -> dict[str, str]:
    """Clean and model a staged export, add what is new, and leave an audit row.

    Deployments and readings already on record stay as they are, so a second run with
    the same export adds only to the audit. Returns name -> path.
    """
    spark = staged.sparkSession
    paths = {name: f"{folder}/{name}" for name in ("deployments", "readings", "load_log")}
    clean = stored(clean_readings(staged), "clean-readings")
    new = keys.derive_dimension(clean, DEPLOYMENT, "timestamp", "deployment_start", "deployment_end")
    dim = tables.extend_dimension(new, paths["deployments"], DEPLOYMENT, "deployment_id")
    fact = keys.require_resolved(readings(clean, dim), "deployment_id")
    tables.insert_if_absent(fact, paths["readings"], ["deployment_id", "timestamp"])
    audit = tables.load_audit(
        staged, clean, tables.existing_log(spark, paths["load_log"]), pipeline="sql",
        source_file=source_file, started_at=started_at, finished_at=finished_at, notes="full run",
    )
    tables.append_table(audit, paths["load_log"])
    return paths


def constraints(fact: DataFrame, dim: DataFrame) -> DataFrame:
    report = quality.constraint_report(
        fact,
        {
            "deployment present": F.col("deployment_id").isNotNull(),
            "time present": F.col("timestamp").isNotNull(),
            "temperature present": F.col("temp_c").isNotNull(),
            "temperature in range": F.col("temp_c").between(0, 30),
            "salinity in range": F.col("psal").between(0, 40),
        },
        unique={"one reading per deployment and time": ["deployment_id", "timestamp"]},
        references={"deployment known": (dim, ["deployment_id"])},
    )
    of_dim = quality.constraint_report(
        dim,
        {"ends after it starts": F.col("deployment_end") > F.col("deployment_start")},
        unique={"one row per deployment and depth": DEPLOYMENT},
    )
    return report.unionByName(of_dim)


def reading_flags(
    fact: DataFrame, dim: DataFrame, jump: float = 3, margin: str = "6 hours",
    ranges: Ranges | None = None,
) -> DataFrame:
    """Good readings with their step, spike flag and deployment-edge flag."""
    return series.reading_flags(
        fact, dim, key=["deployment_id"], moment="timestamp", value="temp_c",
        start="deployment_start", end="deployment_end", jump=jump, margin=margin,
        good=F.col("temp_qc").isin(*GOOD_QC), ranges=ranges,
    ).withColumnRenamed("delta", "delta_c")


def daily_analysis(flags: DataFrame) -> DataFrame:
    """Daily mean per depth with the climatology of its day of year."""
    days = series.day_means(series.unflagged(flags), "timestamp", "temp_c", ["nominal_depth_m"])
    judged = series.day_climatology(days, "temp_c", ["nominal_depth_m"])
    return judged.withColumnRenamed("is_warm", "is_warm_day")


def warm_spells(daily: DataFrame, min_days: int = 3) -> DataFrame:
    """Runs of warm days per depth."""
    runs = series.consecutive_runs(
        daily, "day", "is_warm_day", {"avg_temp_c": half_up(F.avg("temp_c"), 2)}, min_days,
        ["nominal_depth_m"],
    )
    return runs.withColumnsRenamed(
        {"run_start": "spell_start", "run_end": "spell_end", "n_rows": "n_days"}
    )


def stratification(daily: DataFrame, surface: float, bottom: float) -> DataFrame:
    """Surface minus bottom temperature on days with both."""
    names = ("surface_temp_c", "bottom_temp_c", "stratification_c")
    return series.pair_difference(daily, "day", "nominal_depth_m", "temp_c", surface, bottom, names)


def trend_by_depth(fact: DataFrame, dim: DataFrame) -> DataFrame:
    good = fact.where(F.col("temp_qc").isin(*GOOD_QC)).join(dim, "deployment_id")
    return series.trend_per_year(good, "temp_c", "timestamp", ["nominal_depth_m"])


def readings_per_deployment(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return quality.coverage(dim, fact, ["deployment_id"], "n_readings")


def flag_counts(flags: DataFrame) -> DataFrame:
    conditions = {
        "n_spike_flagged": F.col("flag_spike"),
        "n_boundary_flagged": F.col("flag_boundary"),
    }
    return quality.filtered_counts(flags, "total_good_or_probable_qc", conditions)


def gate(fact: DataFrame, dim: DataFrame, audit: DataFrame, as_of: datetime) -> DataFrame:
    """The two-tier quality gate over the reading fact.

    Bad rates are counted per deployment id and reported by code and depth.
    """
    checked = quality.quality_gate(
        fact, dim, audit, key=["deployment_id", "timestamp"], dim_key=["deployment_id"],
        required={}, optional=BOUNDS, moment="timestamp", as_of=as_of,
        bad=F.col("temp_qc").isin(*BAD_QC), bad_by=["deployment_id"],
    )
    names = dim.select(
        F.col("deployment_id").cast("string").alias("subject"),
        F.concat_ws(" @ ", "deployment_code", "nominal_depth_m").alias("_name"),
    )
    named = checked.join(names, "subject", "left")
    return named.withColumn("subject", F.coalesce("_name", "subject")).drop("_name")


def year_temperatures(daily: DataFrame, depth: float) -> DataFrame:
    """Yearly mean of daily temperature and of the daily 90th percentile, one depth."""
    one_depth = daily.where(F.col("nominal_depth_m") == depth)
    return series.year_means(one_depth, ["temp_c", "clim_p90"]).withColumnsRenamed(
        {"temp_c": "mean_temp_c", "clim_p90": "p90_temp_c"}
    )


def latest_by_depth(daily: DataFrame, depths: Sequence[float]) -> Mapping[float, DataFrame]:
    """The last day of each depth, for the headline figures."""
    return {
        d: daily.where(F.col("nominal_depth_m") == d).agg(
            F.max("day").alias("day"), F.max_by("temp_c", "day").alias("temp_c")
        )
        for d in depths
    }

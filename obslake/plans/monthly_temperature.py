"""A long temperature record as a monthly series with climatology and warm spells."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions.calendar import decade_of
from obslake.functions.numbers import half_up
from obslake.operators import quality, series
from obslake.operators.cleaning import plausible, shallow
from obslake.sources.delimited import rename_first

MAX_DEPTH_M = 10
PLAUSIBLE_C = (5.0, 26.0)

# Names under which exports carry the three variables.
TIME_NAMES = ["TIME", "time"]
TEMPERATURE_NAMES = ["TEMP", "temperature", "sea_water_temperature"]
DEPTH_NAMES = ["DEPTH", "depth", "NOMINAL_DEPTH"]


def observations(df: DataFrame) -> DataFrame:
    """(time, depth_m, temp_c) from whatever the export calls them; no value, no row."""
    named = rename_first(
        df, {"time": TIME_NAMES, "temp_c": TEMPERATURE_NAMES}, {"depth_m": DEPTH_NAMES}
    )
    return named.dropna(subset=["temp_c"])


def usable(
    obs: DataFrame, max_depth: float = MAX_DEPTH_M, bounds: tuple[float, float] = PLAUSIBLE_C
) -> DataFrame:
    """Surface readings within physical bounds."""
    return obs.where(shallow("depth_m", max_depth) & plausible({"temp_c": bounds}))


def filter_counts(
    obs: DataFrame, max_depth: float = MAX_DEPTH_M, bounds: tuple[float, float] = PLAUSIBLE_C
) -> DataFrame:
    """Observations before and after filtering."""
    kept = shallow("depth_m", max_depth) & plausible({"temp_c": bounds})
    return quality.filter_funnel(obs, {"n_after": kept})


def monthly_series(
    obs: DataFrame, source_url: str, max_depth: float = MAX_DEPTH_M,
    bounds: tuple[float, float] = PLAUSIBLE_C,
) -> DataFrame:
    """The monthly fact: mean, climatology, anomaly, warm flag, provenance."""
    months = series.month_means(usable(obs, max_depth, bounds), "time", "temp_c")
    judged = series.month_anomalies(months, "temp_c")
    stored = {
        "temp_c": "temp_c",
        "clim_mean": "climatology_mean_c",
        "clim_p90": "climatology_p90_c",
        "anomaly": "anomaly_c",
    }
    return judged.select(
        "month_date",
        F.lit(f"surface_lt_{max_depth}m").alias("depth_bin"),
        *[F.col(c).cast("decimal(5,2)").alias(name) for c, name in stored.items()],
        F.coalesce("is_warm", F.lit(False)).alias("is_warm_month"),
        F.lit(source_url).alias("source_url"),
    )


def constraints(fact: DataFrame) -> DataFrame:
    return quality.constraint_report(
        fact,
        {
            "month present": F.col("month_date").isNotNull(),
            "depth bin present": F.col("depth_bin").isNotNull(),
            "temperature present": F.col("temp_c").isNotNull(),
            "temperature in range": F.col("temp_c").between(0, 30),
        },
        unique={"one row per month and depth bin": ["month_date", "depth_bin"]},
    )


def rolling_year(fact: DataFrame) -> DataFrame:
    """The monthly series with the mean of its last twelve rows."""
    kept = fact.select("month_date", "temp_c", "anomaly_c", "is_warm_month")
    return series.rolling_mean(kept, "month_date", "temp_c", 12, "rolling_12mo_avg_c")


def warm_spells(fact: DataFrame, min_months: int = 3) -> DataFrame:
    """Runs of warm months with their mean and peak anomaly."""
    measures = {
        "avg_anomaly_c": half_up(F.avg("anomaly_c"), 2),
        "peak_anomaly_c": half_up(F.max("anomaly_c"), 2),
    }
    runs = series.consecutive_runs(fact, "month_date", "is_warm_month", measures, min_months)
    return runs.withColumnsRenamed(
        {"run_start": "spell_start", "run_end": "spell_end", "n_rows": "n_months"}
    )


def months_by_decade(fact: DataFrame) -> DataFrame:
    decades = fact.groupBy(decade_of(F.year("month_date")).alias("decade"))
    return decades.agg(F.count(F.lit(1)).alias("n_months"))


def warming_trend(fact: DataFrame) -> DataFrame:
    return series.trend_per_year(fact, "temp_c", "month_date")


def run_summary(fact: DataFrame) -> DataFrame:
    """Rows, warm months and the trend quoted after a cleaning run."""
    warm = fact.agg(F.count_if("is_warm_month")).scalar()
    return series.trend_if_enough(fact, "temp_c", "month_date").withColumn("n_warm", warm)


def dashboard(fact: DataFrame) -> Mapping[str, DataFrame]:
    """What the monthly dashboard reads."""
    return {
        "monthly": rolling_year(fact),
        "spells": warm_spells(fact),
        "coverage": fact.agg(
            F.count(F.lit(1)).alias("n_months"),
            F.min("month_date").alias("earliest"),
            F.max("month_date").alias("latest"),
        ),
    }

"""Survey operators: detection, spread, entity-by-year panels and trends."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def site_list(spark: SparkSession, sites: Sequence[str], name: str) -> DataFrame:
    """A given list of sites as a one-column table."""
    literal = F.array(*[F.lit(s) for s in sites])
    return spark.range(1).select(F.explode(literal).alias(name))


def at_sites(df: DataFrame, sites: DataFrame, key: str) -> DataFrame:
    """Only the rows at the listed sites."""
    return df.join(sites.select(key), key, "left_semi")


def seen(name: str, species: str, total: str) -> Column:
    """The species was actually counted, not merely listed."""
    return (F.col(name) == species) & (F.col(total) > 0)


def first_detection(
    df: DataFrame, site: str, year: Column, present: Column, coordinates: Sequence[str] = ()
) -> DataFrame:
    """First year each site saw the species, flagged where it is also the first survey.

    One pass: the first survey year and the first sighting are conditional minima of
    the same group. Coordinates are minimised independently over the sightings.
    """
    detected = F.min(F.when(present, year))
    return (
        df.groupBy(site)
        .agg(
            *[F.min(F.when(present, F.col(c))).alias(c) for c in coordinates],
            detected.alias("first_detected_year"),
            F.min(year).alias("_first_survey_year"),
        )
        .where(F.col("first_detected_year").isNotNull())
        .withColumn("is_confounded", F.col("first_detected_year") == F.col("_first_survey_year"))
        .drop("_first_survey_year")
    )


def sites_by_year(df: DataFrame, site: str, year: Column, present: Column) -> DataFrame:
    """Number of distinct sites with a sighting per year."""
    found = df.where(present).groupBy(year.alias("yr"))
    return found.agg(F.count_distinct(site).alias("n_sites"))


def range_edge(df: DataFrame, latitude: str, year: Column, present: Column) -> DataFrame:
    """Lowest latitude with a sighting per year."""
    return df.where(present).groupBy(year.alias("yr")).agg(F.min(latitude).alias("edge"))


def sightings(df: DataFrame, place: Sequence[str], year: Column, present: Column, total: str) -> DataFrame:
    """Counted individuals per place and year."""
    return df.where(present).groupBy(*place, year.alias("yr")).agg(F.sum(total).alias("n_seen"))


def sightings_caption(
    seen: DataFrame, place: str, year: str, position: Sequence[str], confounded: Column
) -> DataFrame:
    """What a map of sightings says below it, in one row.

    Records, distinct years and places, first and last year, the mean of each coordinate,
    and the share of records with a confounded position.
    """
    means = [(F.sum(c) / F.count(c)).cast("double").alias(f"mean_{c}") for c in position]
    return seen.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_distinct(year).alias("n_years"),
        F.count_distinct(place).alias("n_places"),
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"),
        *means,
        F.try_divide(F.count_if(confounded), F.count(F.lit(1))).alias("confounded_share"),
    )


def conditional_sums(total: str, conditions: Mapping[str, Column]) -> list[Column]:
    """One sum per condition; rows outside it add zero."""
    return [
        F.sum(F.when(c, F.col(total)).otherwise(F.lit(0))).alias(name)
        for name, c in conditions.items()
    ]


def conditional_mean(value: str, condition: Column) -> Column:
    """Mean over the rows that meet the condition; other rows do not count."""
    chosen = F.when(condition, F.col(value))
    return F.try_divide(F.sum(chosen).cast("double"), F.count(chosen))


def yearly_trend(
    counts: DataFrame, cover: DataFrame, count_year: Column, cover_year: Column,
    sums: Sequence[Column], cover_mean: Column,
) -> DataFrame:
    """Yearly sums next to a yearly mean, for years present in both inputs."""
    left = counts.groupBy(count_year.alias("yr")).agg(*sums)
    return left.join(cover.groupBy(cover_year.alias("yr")).agg(cover_mean), "yr")


def anchored_panel(
    parts: Sequence[DataFrame], key: Sequence[str], zero_filled: Sequence[str] = ()
) -> DataFrame:
    """One row per key present in any part, with the measures of all parts.

    Each part must hold one row per key, so that stacking the parts and folding the stack
    gives the same rows as joining every part to the union of their keys, without the
    joins. Two parts with a measure of the same name are refused.
    """
    named = Counter(c for part in parts for c in part.columns if c not in key)
    if shared := sorted(c for c, n in named.items() if n > 1):
        raise ValueError(f"more than one part has {', '.join(shared)}")
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    measures = [c for c in stacked.columns if c not in key]
    folded = stacked.groupBy(*key).agg(*[F.max(c).alias(c) for c in measures])
    return folded.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero_filled})


def previous_year_value(df: DataFrame, site: str, year: str, value: str, out: str) -> DataFrame:
    """Value of the previous surveyed year at the same site, whatever the gap."""
    return df.withColumn(out, F.lag(value).over(Window.partitionBy(site).orderBy(year)))


def yearly_totals(df: DataFrame, entity: str, year: Column, total: str) -> DataFrame:
    return df.groupBy(entity, year.alias("yr")).agg(F.sum(total).alias("total_count"))


def entity_trends(yearly: DataFrame, entity: str, min_years: int = 10) -> DataFrame:
    """Slope per year, first and last year and their totals, for well-observed entities.

    The values at both ends come from the same aggregate; no join back is needed.
    """
    total = F.col("total_count")
    return (
        yearly.groupBy(entity)
        .agg(
            F.regr_slope(total.cast("double"), F.col("yr").cast("double")).alias("trend_per_year"),
            F.count(F.lit(1)).alias("years_observed"),
            F.min("yr").alias("first_year"),
            F.max("yr").alias("last_year"),
            F.min_by(total, "yr").alias("first_count"),
            F.max_by(total, "yr").alias("last_count"),
        )
        .where(F.col("years_observed") >= min_years)
    )


def supported_series(yearly: DataFrame, entity: str, min_years: int = 10) -> DataFrame:
    """Yearly rows of entities observed in enough years."""
    years = F.count(F.lit(1)).over(Window.partitionBy(entity))
    return yearly.withColumn("_years", years).where(F.col("_years") >= min_years).drop("_years")


def densify_years(yearly: DataFrame, year: str, by: Sequence[str] = ()) -> DataFrame:
    """Every year between the first and last of each series, gaps with NULL measures."""
    span = yearly.groupBy(*by).agg(F.sequence(F.min(year), F.max(year)).alias("_years"))
    frame = span.select(*by, F.explode("_years").alias(year))
    return frame.join(yearly, [*by, year], "left")


def distinct_sketches(df: DataFrame, by: Sequence[str], identifier: str, out: str = "sketch", lg_k: int = 14) -> DataFrame:
    """Per group a mergeable sketch of its distinct identifiers (HyperLogLog, 2^lg_k registers).

    A sketch has at most about 2^lg_k bytes however many identifiers it has seen, and errs
    by about 1.04 / sqrt(2^lg_k). Written down once per (site, year), any span of years or
    set of sites is a union of sketches; no row of the records is read again.
    """
    return df.where(F.col(identifier).isNotNull()).groupBy(*by).agg(F.hll_sketch_agg(identifier, lg_k).alias(out))


def united_distinct(sketches: DataFrame, by: Sequence[str], out: str, sketch: str = "sketch") -> DataFrame:
    """Estimated distinct identifiers per (coarser) group of a table of sketches."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(out))

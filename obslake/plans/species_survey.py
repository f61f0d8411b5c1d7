"""Long-format species surveys: cleaning, spread of a species, site-year panels, trends."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.functions.numbers import ordered_tier
from obslake.functions.text import blank_to_null, display_label
from obslake.operators import panel, quality, stats
from obslake.operators.cleaning import structurally_sound, with_required
from obslake.schemas import SURVEY_KEPT, SURVEY_KEPT_BY_KIND, SURVEY_TYPES
from obslake.sources import tables

REQUIRED_KEYS = ["site_code", "survey_id", "survey_date", "species_name"]
TIERS = ["none", "low", "medium", "high"]
TIER_TOPS = [0, 3, 9]


def typed_rows(raw: DataFrame) -> DataFrame:
    """Typed survey rows; blanks, also of the time of day, become NULL, rows without keys go."""
    kinds = SURVEY_TYPES | {"hour": "string"}
    casts = {c: blank_to_null(F.col(c)).cast(kinds[c]) for c in raw.columns if c in kinds}
    return with_required(raw.withColumns(casts), REQUIRED_KEYS)


def clean_rows(rows: DataFrame, kind: str, area: str) -> DataFrame:
    """Rows of the region that every analysis can use, with the columns that are kept."""
    optional = ["biomass"] if "biomass" in SURVEY_KEPT_BY_KIND[kind] else []
    sound = structurally_sound(("area", area), ["latitude", "longitude"], ["total"], optional)
    return rows.where(sound).select(*SURVEY_KEPT, *SURVEY_KEPT_BY_KIND[kind])


def constraints(clean: DataFrame, raw: DataFrame, kind: str) -> DataFrame:
    """Violations of the clean table's rules; all zero before loading."""
    present = ["survey_id", "site_code", "latitude", "longitude", "survey_date", "species_name", "total"]
    checks = {f"{c} present": F.col(c).isNotNull() for c in present}
    measures = [c for c in ("total", "biomass") if c in SURVEY_KEPT_BY_KIND[kind]]
    checks |= {f"{c} not negative": F.col(c) >= 0 for c in measures}
    return quality.constraint_report(
        clean, checks, unique={"one row per fid": ["fid"]}, references={"fid known": (raw, ["fid"])}
    )


def load(raw: DataFrame, kind: str, area: str, path: str) -> None:
    """Add the clean rows the table does not hold yet. Running it again adds nothing."""
    tables.insert_if_absent(clean_rows(raw, kind, area), path, ["fid"])


def _year() -> Column:
    return F.year("survey_date")


def _is(species: str) -> Column:
    return F.col("species_name") == species


def first_detection(animals: DataFrame, species: str) -> DataFrame:
    present = panel.seen("species_name", species, "total")
    return panel.first_detection(animals, "site_code", _year(), present, ["latitude", "longitude"])


def sites_by_year(animals: DataFrame, species: str) -> DataFrame:
    present = panel.seen("species_name", species, "total")
    counted = panel.sites_by_year(animals, "site_code", _year(), present)
    return counted.withColumnRenamed("n_sites", "colonized_sites")


def range_edge(animals: DataFrame, species: str) -> DataFrame:
    present = panel.seen("species_name", species, "total")
    edge = panel.range_edge(animals, "latitude", _year(), present)
    return edge.withColumnRenamed("edge", "southernmost_latitude")


def sightings(animals: DataFrame, species: str) -> DataFrame:
    present = panel.seen("species_name", species, "total")
    place = ["site_code", "latitude", "longitude"]
    return panel.sightings(animals, place, _year(), present, "total").withColumnRenamed("n_seen", "count")


def site_names_by_year(seen: DataFrame, years: DataFrame) -> DataFrame:
    """The sites behind each year's count, as text."""
    return stats.listed_for(years, stats.ids_by_group(seen, "yr", "site_code"), "yr")


def yearly_trend(
    animals: DataFrame, cover: DataFrame, sites: DataFrame, counted: Mapping[str, str],
    prefixed: Mapping[str, str], habitat: str = "Canopy",
) -> DataFrame:
    """Yearly counts of given species and species groups next to habitat cover."""
    conditions = {name: _is(s) for name, s in counted.items()}
    conditions |= {name: F.col("species_name").startswith(p) for name, p in prefixed.items()}
    sums = panel.conditional_sums("total", conditions)
    covered = panel.conditional_mean("total", F.col("habitat_groups") == habitat)
    return panel.yearly_trend(
        panel.at_sites(animals, sites, "site_code"), panel.at_sites(cover, sites, "site_code"),
        _year(), _year(), sums, covered.alias("canopy_pct"),
    )


def site_year_panel(
    animals: DataFrame, cover: DataFrame, fish: DataFrame, sites: DataFrame,
    invasive: str, native: str, habitat: str = "Canopy",
) -> DataFrame:
    """One row per site and year present in any of the three tables."""
    key = ["site_code", "yr"]

    def grouped(df: DataFrame):
        return panel.at_sites(df, sites, "site_code").groupBy("site_code", _year().alias("yr"))

    counts = {"invasive_urchin_count": _is(invasive), "native_urchin_count": _is(native)}
    urchin = grouped(animals).agg(*panel.conditional_sums("total", counts))
    covered = panel.conditional_mean("total", F.col("habitat_groups") == habitat)
    canopy = grouped(cover).agg(covered.alias("canopy_pct"))
    life = grouped(fish).agg(
        F.count_distinct("species_name").alias("fish_richness"),
        F.sum("biomass").alias("fish_biomass"),
        F.sum("total").alias("fish_count"),
    )
    return panel.anchored_panel([urchin, canopy, life], key, list(counts))


def predator_lag(animals: DataFrame, predator: str, prey: str) -> DataFrame:
    """Predator and prey counts per site and year, with the previous year's predators."""
    sums = panel.conditional_sums("total", {"lobster": _is(predator), "urchin": _is(prey)})
    yearly = animals.groupBy("site_code", _year().alias("yr")).agg(*sums)
    return panel.previous_year_value(yearly, "site_code", "yr", "lobster", "lobster_prev_year")


def lag_tiers(lagged: DataFrame) -> DataFrame:
    """Pairs with a previous year, binned by its predator count."""
    pairs = lagged.dropna(subset=["lobster_prev_year"])
    tier = ordered_tier(F.col("lobster_prev_year"), TIER_TOPS, TIERS)
    return pairs.withColumn("lobster_tier", tier)


def lag_report(lagged: DataFrame) -> Mapping[str, DataFrame]:
    """Correlation, mean and box summary of prey by predator tier."""
    tiered = lag_tiers(lagged)
    return {
        "correlation": stats.correlations(tiered, {"corr_lag": ("lobster_prev_year", "urchin")}),
        "means": stats.tier_means(tiered, "lobster_tier", "urchin", TIERS),
        "boxes": stats.tier_boxes(tiered, "lobster_tier", "urchin"),
    }


def canopy_correlations(site_years: DataFrame) -> DataFrame:
    """Correlation of cover with richness and with both urchin counts."""
    return stats.correlations(
        site_years,
        {
            "corr_richness": ("canopy_pct", "fish_richness"),
            "corr_invasive": ("canopy_pct", "invasive_urchin_count"),
            "corr_native": ("canopy_pct", "native_urchin_count"),
        },
    )


def richness_slice(site_years: DataFrame, sites: list[str], first: int, last: int) -> DataFrame:
    """Complete site-years of the chosen sites and years, with marker sizes."""
    complete = site_years.dropna(subset=["canopy_pct", "fish_richness", "fish_biomass"])
    chosen = complete.where(F.col("site_code").isin(sites) & F.col("yr").between(first, last))
    return stats.marker_sizes(chosen, "fish_biomass", 6, 22, 8)


def fish_by_year(fish: DataFrame) -> DataFrame:
    return panel.yearly_totals(fish, "species_name", _year(), "total")


def species_trends(fish: DataFrame, min_years: int = 10) -> DataFrame:
    return panel.entity_trends(fish_by_year(fish), "species_name", min_years)


def species_series(fish: DataFrame, min_years: int = 10) -> DataFrame:
    return panel.supported_series(fish_by_year(fish), "species_name", min_years)


def risers_and_fallers(trends: DataFrame, common_names: DataFrame, n: int = 10) -> DataFrame:
    """The n strongest rises and falls, labelled with a common name where one is known."""
    ranked = stats.extremes(trends, "trend_per_year", n, "species_name")
    named = ranked.join(common_names, "species_name", "left")
    label = display_label(F.col("species_name"), F.col("common_name"))
    return named.withColumn("label", label).drop("common_name")

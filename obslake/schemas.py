"""Fixed schemas of the four kinds of source. Types are what the tables store."""

from __future__ import annotations

# Sensor export header, in file order.
SENSOR_HEADER = [
    "FID", "timeseries_id", "index", "site_code", "platform_code",
    "deployment_code", "instrument_nominal_depth", "TIME", "TIME_quality_control",
    "LATITUDE", "LATITUDE_quality_control", "LONGITUDE", "LONGITUDE_quality_control",
    "DEPTH", "DEPTH_quality_control", "TEMP", "TEMP_quality_control",
    "CNDC", "CNDC_quality_control", "PSAL", "PSAL_quality_control",
    "PRES", "PRES_quality_control", "PRES_REL", "PRES_REL_quality_control",
    "geom", "depth_b", "sea_water_temperature_b",
    "sea_water_electrical_conductivity_b", "sea_water_salinity_b",
    "sea_water_pressure_b", "sea_water_pressure_due_to_sea_water_b",
]

# Clean sensor column -> (export column, stored type).
SENSOR_TYPES = {
    "site_code": ("site_code", "string"),
    "deployment_code": ("deployment_code", "string"),
    "nominal_depth_m": ("instrument_nominal_depth", "decimal(5,1)"),
    "timestamp": ("TIME", "timestamp"),
    "latitude": ("LATITUDE", "double"),
    "longitude": ("LONGITUDE", "double"),
    "depth_m": ("DEPTH", "decimal(18,6)"),
    "depth_qc": ("DEPTH_quality_control", "smallint"),
    "temp_c": ("TEMP", "decimal(18,6)"),
    "temp_qc": ("TEMP_quality_control", "smallint"),
    "psal": ("PSAL", "decimal(18,6)"),
    "psal_qc": ("PSAL_quality_control", "smallint"),
}

# Columns every survey export starts with, then those of each kind.
SURVEY_COMMON = [
    "fid", "survey_id", "country", "area", "ecoregion", "realm", "location",
    "site_code", "site_name", "latitude", "longitude", "survey_date", "depth",
    "program", "visibility", "hour", "survey_latitude", "survey_longitude", "method",
]
SURVEY_ANIMALS = [
    "block", "phylum", "class", "order", "family", "species_name", "reporting_name",
    "size_class", "total", "biomass", "geom",
]
SURVEY_COVER = [
    "phylum", "class", "order", "family", "species_name", "reporting_name",
    "report_group", "habitat_groups", "quadrat", "total", "geom",
]
SURVEY_HEADERS = {
    "fish": SURVEY_COMMON + SURVEY_ANIMALS,
    "invertebrate": SURVEY_COMMON + SURVEY_ANIMALS,
    "benthic": SURVEY_COMMON + SURVEY_COVER,
}

# Survey columns that are not text.
SURVEY_TYPES = {
    "latitude": "double",
    "longitude": "double",
    "survey_date": "date",
    "depth": "double",
    "visibility": "double",
    "survey_latitude": "double",
    "survey_longitude": "double",
    "total": "decimal(18,6)",
    "biomass": "decimal(18,6)",
}

# What the cleaned survey tables keep.
SURVEY_KEPT = [
    "fid", "survey_id", "site_code", "site_name", "latitude", "longitude",
    "survey_date", "depth", "method", "species_name", "reporting_name",
]
SURVEY_KEPT_BY_KIND = {
    "fish": ["size_class", "total", "biomass"],
    "invertebrate": ["size_class", "total", "biomass"],
    "benthic": ["habitat_groups", "quadrat", "total"],
}

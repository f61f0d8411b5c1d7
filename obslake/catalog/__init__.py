"""Registered queries over the TPC-H-like tables, each next to its SQL twin."""

from obslake.catalog import (  # noqa: F401
    cleaning,
    loading,
    quality,
    reports,
    seasons,
    sensors,
    surveys,
)
from obslake.catalog.registry import oracles, registered

__all__ = ["oracles", "registered"]

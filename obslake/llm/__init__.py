"""Operators for building training corpora, and their registered queries."""

from obslake.llm import (  # noqa: F401
    catalog_corpus,
    catalog_native,
    catalog_search,
    catalog_text,
    catalog_turns,
)
from obslake.llm.registry import oracles, registered

__all__ = ["oracles", "registered"]

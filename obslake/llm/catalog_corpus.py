"""Queries over the operators that compare each text with the whole corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from obslake.catalog.registry import Tables
from obslake.llm import near_duplicates, ngram_lm, repeated_strings
from obslake.llm.registry import query
from obslake.llm.words import fold


@query()
def op3_language_model(t: Tables):
    part = fold("doc_id", 7)
    scored = ngram_lm.score_texts(t.documents, training=part != 2, deleted=part == 3)
    return scored.select(
        "doc_id", (part == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query()
def op4_near_duplicates(t: Tables):
    return near_duplicates.near_duplicate_groups(t.documents)


@query()
def op2_repeated_strings(t: Tables):
    found = repeated_strings.repeated_spans(t.documents)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )

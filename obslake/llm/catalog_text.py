"""Queries over the packing, language and toxicity operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from obslake.catalog.registry import Tables
from obslake.llm import language_id, packing, toxicity
from obslake.llm.registry import query
from obslake.llm.words import fold


@query()
def op1_pack(t: Tables):
    return packing.pack(t.documents, public_tokenizers.path("word_bpe_49k.json"), with_ids=False, cached_words=600_000)


@query()
def op5_language_id(t: Tables):
    held_out = fold("doc_id", 5) == 0
    model = language_id.train(t.documents.where(~held_out))
    judged = language_id.detect(t.documents.select("doc_id", "text"), model)
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query()
def op10_toxicity(t: Tables):
    held_out = fold("doc_id", 5) == 0
    model = toxicity.train(t.documents, t.labels.where(~held_out))
    scored = toxicity.score_documents(t.documents.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")

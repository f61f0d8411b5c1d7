"""From raw documents to packed training sequences, one operator a stage.

Each stage gets what the one before it kept, written as Parquet and read again. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm import language_id, line_dedup, mixing, near_duplicates, packing
from obslake.session import ready, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "word_bpe_49k.json"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that makes up at least half of their words.

    Null and letterless texts have none and go. The model learns from the given languages.
    """
    model = language_id.train(docs)
    judged = language_id.detect(docs.select(*COLUMNS), model)
    return judged.where(language_id.accepted(F.col("lang_pred"), F.col("score"))).select(*COLUMNS)


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that at least three of them share.

    A shared line stays in the document with the largest id; n_chars follows the text.
    """
    kept = line_dedup.drop_repeated_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id.

    Documents without an id or without a word are no duplicates and stay.
    """
    groups = near_duplicates.near_duplicate_groups(docs.select("doc_id", "text"))
    later = groups.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(later, "doc_id", "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, always whole.

    The one document at which the quota of a shard (about a million words of a source) ends
    is taken once more if at least half of it is in the quota. Documents of which less is
    taken go, and so do those without a word or an id. Ids repeat with the copies (rows that
    share an id are taken alike).
    """
    docs = docs.select(*COLUMNS)
    mix = mixing.mix_sources(docs).where("taken > 0")
    most = mix.groupBy("doc_id").agg(F.max(F.struct("taken", "size")).alias("_most")).select("doc_id", "_most.*")
    copies = F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size"))).cast("int")
    times = F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy")
    return docs.join(most, "doc_id").select(*COLUMNS, times).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their place in a sequence, and their token ids."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", known_language),
    ("line dedup", own_lines),
    ("near duplicates", one_of_each),
    ("mixing sources", mixed),
    ("best-fit packing", packed),
]

# Mixture inference and tokenising have no SQL; tests compare with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder."""
    docs = ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

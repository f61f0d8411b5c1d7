"""Queries over the operators that are built-in functions throughout."""

from __future__ import annotations

from pyspark.sql import functions as F

from obslake.catalog.registry import Tables
from obslake.llm import line_dedup, mixing, quality_rules
from obslake.llm.registry import query

_KEY = r"translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    f"""
    WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    l AS (SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM d),
    k AS (SELECT doc_id, pos, line, {_KEY} AS key FROM l),
    s AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20
          GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    m AS (SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.last AS gone
          FROM k LEFT JOIN s ON k.key = s.key)
    SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id
    """
)
def op6_line_dedup(t: Tables):
    kept = line_dedup.drop_repeated_lines(t.documents.select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op7_mix_sources(t: Tables):
    mix = mixing.mix_sources(t.documents)
    return mix.select("doc_id", "size", "source_size", "target", "taken")


@query(
    r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
                      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    i AS (SELECT doc_id, unnest(range(len(w) - 4)) AS pos, w FROM d WHERE len(w) >= 5),
    g AS (SELECT doc_id, pos, w[pos + 1 : pos + 5] AS gram FROM i),
    r AS (SELECT doc_id, pos FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) >= 2),
    c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(pos, pos + 5)) AS p FROM r)
          GROUP BY doc_id),
    m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
                 CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                 CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
                 len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echoes,
                 coalesce(c.n, 0) AS n_repeat_words
          FROM d LEFT JOIN c ON c.doc_id = d.doc_id),
    f AS (SELECT doc_id, n_words, word_chars, n_symbols, n_repeat_words, n_echoes, len(ls) AS n_lines,
                 CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
                 n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 100 * n_symbols > 10 * n_words
                OR n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines OR 100 * n_echoes > 30 * n_words
                OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
    FROM f
    """
)
def op8_quality_rules(t: Tables):
    judged = quality_rules.apply_policy(quality_rules.ledger(t.documents.select("doc_id", "text")), "v2")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"), "kept",
    )

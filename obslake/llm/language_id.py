"""Language identification by multilingual mixture inference.

A language is a distribution over hashed letter trigrams of words. A document is a
mixture: each word comes from one language, and expectation-maximisation finds the
proportions. Languages join the document's set while the likelihood gains more than
their penalty; the largest proportion is the prediction.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obslake.llm.words import widened
from obslake.llm.worker import give_back

UNKNOWN = "und"
BUCKETS = 1 << 16
PIECE = 1 << 21  # bytes looked at together
# Bytes that are no letters become spaces; bytes from 128 on belong to letters.
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_likelihood: np.ndarray  # (buckets, languages), float32


def _trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each trigram of the lower-cased words, and where each word's begin."""
    raw = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b"  "
    b = np.frombuffer(raw, np.uint8)
    if len(b) < 4:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = b[:-2].astype(np.uint32) << 16 | b[1:-1].astype(np.uint32) << 8 | b[2:]
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
    # The trigram that starts at a word's last letter would hold the next word's first.
    spans_two = b[1:-1] == 32
    starts = np.flatnonzero(b[:-2] == 32)
    keep = ~spans_two
    shift = np.cumsum(keep) - keep
    return bucket[keep].astype(np.int64), shift[starts]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            bucket, _ = _trigrams(text.as_py())
            if language not in totals:
                totals[language] = np.zeros(BUCKETS, np.int64)
            if len(bucket) > BUCKETS:
                totals[language] += np.bincount(bucket, minlength=BUCKETS)
            else:
                np.add.at(totals[language], bucket, 1)
    for language, total in totals.items():
        found = np.flatnonzero(total)
        yield pa.record_batch(
            [pa.array([language] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(total[found])],
            names=["_lang", "_bucket", "_n"],
        )


def train(df: DataFrame, text: str = "text", lang: str = "lang", smoothing: float = 0.5) -> LanguageModel:
    """Trigram distributions of every language among rows with text and a language.

    Counted over all rows given. The driver receives at most 65,536 counts a language.
    Without a usable row the model knows no language.
    """
    rows = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("_lang"), F.col(text).alias("_text")
    )
    counts = (
        rows.mapInArrow(_counts, "_lang string, _bucket int, _n long")
        .groupBy("_lang", "_bucket")
        .agg(F.sum("_n").alias("_n"))
        .toPandas()
    )
    languages = tuple(sorted(counts["_lang"].unique()))
    table = np.full((BUCKETS, len(languages)), smoothing)
    at = {name: i for i, name in enumerate(languages)}
    table[counts["_bucket"].to_numpy(np.int64), counts["_lang"].map(at).to_numpy(np.int64)] += counts["_n"].to_numpy()
    return LanguageModel(languages, np.log(table / table.sum(axis=0)).astype(np.float32))


def _word_likelihoods(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word its likelihood under each language, scaled to at most 1; words per text."""
    found, sizes = [], []
    for text in texts:
        bucket, starts = _trigrams(text)
        sizes.append(len(starts))
        if len(starts):
            found.append(np.add.reduceat(table[bucket], starts, axis=0))
    if not found:
        return np.zeros((0, table.shape[1]), np.float32), np.array(sizes, np.int64)
    log = np.concatenate(found)
    return np.exp(log - log.max(axis=1, keepdims=True)), np.array(sizes, np.int64)


def _mixture(words, starts, of, allowed, rounds):
    """Proportions of each text, only over its allowed languages, and its log likelihood."""
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    sizes = np.diff(np.append(starts, len(words)))[:, None]
    for _ in range(rounds):
        weighted = words * shares[of]
        weighted /= np.maximum(weighted.sum(axis=1, keepdims=True), 1e-30)
        shares = np.add.reduceat(weighted, starts, axis=0) / sizes
    likelihood = np.log(np.maximum((words * shares[of]).sum(axis=1), 1e-30))
    return shares, np.add.reduceat(likelihood, starts)


def _proportions(words: np.ndarray, sizes: np.ndarray, rounds: int, penalty: float) -> np.ndarray:
    """Language shares of each text with words, after choosing its set of languages."""
    n, languages = len(sizes), words.shape[1]
    result = np.zeros((n, languages))
    full = np.flatnonzero(sizes)
    if not len(full):
        return result
    starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
    of = np.repeat(np.arange(len(full)), sizes[full])
    log = np.log(np.maximum(words, 1e-30))
    single = np.add.reduceat(log, starts, axis=0)
    chosen = np.zeros((len(full), languages))
    chosen[np.arange(len(full)), single.argmax(axis=1)] = 1
    shares, best = chosen.copy(), single.max(axis=1)
    # Scaled likelihoods are at most 1, so no set of languages can gain more than -best; and
    # as the likelihood is concave in the shares, a language gains nothing at all unless its
    # likelihood ratio to the chosen one is over 1 on average.
    ratio = words / np.maximum(words[np.arange(len(words)), chosen.argmax(axis=1)[of]], 1e-30)[:, None]
    rising = np.add.reduceat(ratio, starts, axis=0).max(axis=1) > sizes[full]
    open_texts = np.flatnonzero(rising & (-best > penalty * np.log(sizes[full] + 1)))
    for _ in range(languages - 1):
        if not len(open_texts):
            break
        mine = np.isin(of, open_texts)
        part, size = words[mine], np.bincount(of[mine], minlength=len(full))[open_texts]
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        owner = np.repeat(np.arange(len(open_texts)), size)
        gain, better = np.full(len(open_texts), -np.inf), [None] * languages
        winner = np.zeros(len(open_texts), np.int64)
        for language in range(languages):
            allowed = chosen[open_texts].copy()
            new = allowed[:, language] == 0
            allowed[:, language] = 1
            share, likelihood = _mixture(part, begin, owner, allowed, rounds)
            better[language] = share
            ahead = np.where(new, likelihood - best[open_texts], -np.inf)
            winner = np.where(ahead > gain, language, winner)
            gain = np.maximum(gain, ahead)
        cost = penalty * np.log(size + 1)
        grown = np.flatnonzero(gain > cost)
        for i in grown:
            text = open_texts[i]
            chosen[text, winner[i]] = 1
            shares[text] = better[winner[i]][i]
            best[text] += gain[i]
        open_texts = open_texts[grown]
    result[full] = shares
    return result


def detect(
    df: DataFrame,
    model: LanguageModel,
    text: str = "text",
    lang_pred: str = "lang_pred",
    score: str = "score",
    languages: str = "languages",
    rounds: int = 6,
    penalty: float = 2.0,
) -> DataFrame:
    """``df`` with the predicted language, its share of the words, and all shares.

    ``und`` and 0 for null or letterless text, or when the model knows no language.
    ``penalty`` is the log likelihood, per log of the number of words, that a further
    language must gain. Ties go to the language whose name comes first. Existing columns
    with the names of the new ones are replaced; the text is read whole.
    """
    names, table = model.languages, model.log_likelihood
    own = [c for c in df.columns if c not in (lang_pred, score, languages)]

    def judged(texts: list[str | None]) -> tuple[list, list, list]:
        usable = [i for i, x in enumerate(texts) if has_letter(x)] if names else []
        words, sizes = _word_likelihoods([texts[i] for i in usable], table)
        shares = _proportions(words, sizes, rounds, penalty)
        tags, scores, parts = [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in texts]
        for i, row in zip(usable, shares):
            if row.sum() > 0:
                top = int(row.argmax())
                tags[i], scores[i] = names[top], min(1.0, float(row[top]))
                parts[i] = [(names[k], float(row[k])) for k in np.argsort(-row, kind="stable") if row[k] > 0.001]
        return tags, scores, parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_type = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        for batch in batches:
            texts = batch.column(own.index(text)).to_pylist()
            tags, scores, parts = [], [], []
            begin = held = 0
            for i, one in enumerate(texts):
                held += len(one or "")
                if held >= PIECE or i == len(texts) - 1:
                    for whole, piece in zip((tags, scores, parts), judged(texts[begin : i + 1])):
                        whole.extend(piece)
                    begin, held = i + 1, 0
            new = [pa.array(tags, pa.string()), pa.array(scores, pa.float64())]
            new.append(pa.array([[dict(lang=a, share=b) for a, b in p] for p in parts], part_type))
            yield pa.record_batch([*batch.columns, *new], names=[*batch.schema.names, lang_pred, score, languages])
            del texts, tags, scores, parts, new
            give_back()

    added = StructType.fromDDL(f"`{lang_pred}` string, `{score}` double, `{languages}` array<struct<lang:string,share:double>>")
    return widened(df, own, run, added)


def accepted(lang_pred: Column, score: Column, least_share: float = 0.5) -> Column:
    """Whether a document has a language and that language makes up enough of it."""
    return (lang_pred != UNKNOWN) & (score >= least_share)

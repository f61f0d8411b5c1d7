"""Language-model scoring by deleted interpolation.

The probability of a token mixes the uniform, the unigram and the bigram estimate with
weights that depend on how often the context was seen. The weights maximise, by
expectation-maximisation, the likelihood of a deleted part of the training texts under
counts of the remaining part; the final counts are those of all training texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm import blocks as B
from obslake.session import stored

U = np.uint64
START, END = U(0x1F83D9ABFB41BD6B), U(0x5BE0CD19137E2179)
KINDS = WORD, CONTEXT, PAIR = 0, 1, 2
CONTEXT_BUCKETS = 24
CELLS = 96  # of a quarter of an octave each


class Events:
    """The tokens of a block's texts: each predicts itself from the one before."""

    def __init__(self, block: B.Block, bits: int) -> None:
        words, counts = B.word_hashes(block.texts)
        self.sizes = counts + 1
        n = int(self.sizes.sum())
        self.starts = np.cumsum(self.sizes) - self.sizes
        last = self.starts + self.sizes - 1
        inside = np.ones(n, bool)
        inside[last] = False
        token = np.full(n, END, U)
        token[inside] = words
        before = np.empty(n, U)
        before[1:] = token[:-1]
        before[self.starts] = START
        self.of = np.repeat(np.arange(len(self.sizes)), self.sizes)
        # The two lowest bits of a key tell its kind.
        kinds = (token, B.mixed(before), B.chained(before, token))
        keys = np.concatenate([B.shortened(k, bits) >> U(2) << U(2) | U(kind) for kind, k in enumerate(kinds)])
        weights = np.tile(block.weights[self.of][:, :2], (3, 1))
        self.keys, where, self.sums = B.distinct_keys(keys, weights)
        self.word, self.context, self.pair = where[:n], where[n : 2 * n], where[2 * n :]


def _bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, then one bucket per doubling of its frequency."""
    return np.minimum(np.ceil(np.log2(count + 1)), CONTEXT_BUCKETS - 1).astype(np.int64)


def _cell(x: np.ndarray) -> np.ndarray:
    """0 for 0, else the quarter octave below 1."""
    with np.errstate(divide="ignore"):
        return np.where(x > 0, np.clip(1 + np.round(-4 * np.log2(x)), 1, CELLS - 1), 0).astype(np.int64)


def _cell_value(cell: np.ndarray) -> np.ndarray:
    return np.where(cell > 0, 2.0 ** (-(cell - 1) / 4), 0.0)


def _held_out_cells(events: Events, totals: np.ndarray, weights: np.ndarray, tokens: int):
    """Deleted events, counted per context bucket and cells of both estimates."""
    rest = totals[:, 0]
    context = rest[events.context]
    pair = rest[events.pair] / np.maximum(context, 1)
    word = rest[events.word] / max(tokens, 1)
    code = (_bucket(context) * CELLS + _cell(pair)) * CELLS + _cell(word)
    codes, where, _ = B.distinct_keys(code)
    return codes, np.bincount(where, weights=weights[events.of], minlength=len(codes)).astype(np.int64)


def mixture_weights(bucket, pair, word, uniform: float, n, rounds: int = 60) -> np.ndarray:
    """Per context bucket the weights of (uniform, word, pair), by expectation-maximisation.

    Each bucket starts from, and is drawn as if by a few events towards, the weights of
    all buckets together, so that no estimate that may be needed gets weight 0.
    """
    parts = np.stack([np.full(len(n), uniform), word, pair], axis=1)

    def climb(rows: np.ndarray, counts: np.ndarray, prior: np.ndarray, strength: float) -> np.ndarray:
        weights = prior.copy()
        for _ in range(rounds):
            share = rows * weights
            share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
            weights = (counts[:, None] * share).sum(axis=0) + strength * prior
            weights /= weights.sum()
        return weights

    even = np.full(3, 1 / 3)
    whole = climb(parts, n, even, 3.0) if len(n) else even
    table = np.tile(whole, (CONTEXT_BUCKETS, 1))
    for b in range(CONTEXT_BUCKETS):
        mine = bucket == b
        if mine.any():
            table[b] = climb(parts[mine], n[mine], whole, 10.0)
    # An unseen context has no pair estimate; what it leaves goes to the others.
    table[0, 2] = 0
    return table / table.sum(axis=1, keepdims=True)


_SCORES = (
    "_k1 long, _k2 long, n_tokens long, n_known long, base_score double, score double"
)


def score_texts(
    df: DataFrame,
    training: Column,
    deleted: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    fan: int = B.FAN,
) -> DataFrame:
    """Per row: its id, n_tokens, n_known, train_tokens, base_score and score (log10).

    ``training`` says which rows are counted; ``deleted`` which of these are held out to
    learn the weights. Tokens are words in lower case (A-Z) and one end per text. The
    base is an add-one unigram model.

    Null text is empty, one end token. Equal texts are counted as often as they occur and
    scored once. Null or repeated ids are rows of their own; other columns do not matter.
    Without training rows all tokens are unknown and share one uniform probability. An
    empty table gives an empty result.
    """
    role = F.when(~F.coalesce(training, F.lit(False)), 0).when(F.coalesce(deleted, F.lit(False)), 2).otherwise(1)
    rows = df.select(F.col(doc_id).alias("_id"), F.col(text).alias("_x"), role.alias("_role"))
    size = B.text_bytes(rows, "_x")
    # Deleted texts have blocks of their own, so that learning the weights reads only those.
    rows = rows.withColumn("_family", (F.col("_role") == 2).cast("int"))
    texts = B.keyed_texts(rows, "_x", ["_id", "_role", "_family"], family="_family")
    n_blocks = B.block_count(size)
    deleted_blocks = max(1, n_blocks // 6)
    block = F.when(
        F.col("_family") == 1, n_blocks + F.pmod("_k1", F.lit(deleted_blocks))
    ).otherwise(F.pmod("_k1", F.lit(n_blocks)))
    texts = texts.withColumns({
        "_block": block, "_rest": (F.col("_role") == 1).cast("int"), "_deleted": (F.col("_role") == 2).cast("int"),
    })

    def dealt(chosen: DataFrame) -> DataFrame:
        return B.dealt(chosen, n_blocks, ["_rest", "_deleted"], "_block")

    bits = B.key_bits(size / 3, 30)
    tree = B.owner_tree(n_blocks // 2, fan)
    asked_schema = pa.schema([("_owner", pa.int32()), ("_block", pa.int32()), ("_data", pa.binary())])

    def ask(table: pa.Table) -> pa.Table:
        number = table.column("_block")[0].as_py()
        block = B.Block(table.column("_texts").to_pylist())
        events = Events(block, bits)
        rows = [(owner, number, data) for owner, data in B.questions(events.keys, events.sums.T, tree.fan, bits)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), asked_schema)], schema=asked_schema)

    def word_totals(keys: np.ndarray, sums: np.ndarray) -> tuple[int, ...]:
        """Distinct words and tokens, without the deleted texts and with them."""
        words = sums[(keys & U(3)) == WORD]
        both = words.sum(axis=1)
        return int((words[:, 0] > 0).sum()), int((both > 0).sum()), int(words[:, 0].sum()), int(both.sum())

    asked = dealt(texts).groupBy("_block").applyInArrow(
        ask, "_owner int, _block int, _data binary"
    )
    answers = stored(B.answered(asked, tree, bits, word_totals), "ngram-counts")
    summed = answers.where("_block = -1").select(*[F.sum(F.get("_summary", i)) for i in range(4)]).first()
    rest_words, all_words, rest_tokens, tokens = (x or 0 for x in summed)

    def with_answers(chosen: DataFrame, from_block: int, run, schema: str) -> DataFrame:
        own = answers.where(F.col("_block") >= from_block).select("_block", "_owner", "_data")
        return dealt(chosen).groupBy("_block").cogroup(own.groupBy("_block")).applyInArrow(run, schema)

    def count_cells(left: pa.Table, right: pa.Table) -> pa.Table:
        block = B.Block(left.column("_texts").to_pylist())
        events = Events(block, bits)
        codes, n = _held_out_cells(events, B.totals_in_order(right, 2), block.weights[:, 1], rest_tokens)
        return pa.table({"_code": pa.array(codes, pa.int64()), "_n": pa.array(n, pa.int64())})

    # No more rows than there are cells reach the driver.
    cells = (
        with_answers(texts.where("_family = 1"), n_blocks, count_cells, "_code long, _n long")
        .groupBy("_code").agg(F.sum("_n").alias("_n")).toPandas()
    )
    code, n = cells["_code"].to_numpy(np.int64), cells["_n"].to_numpy(np.float64)
    table = mixture_weights(
        code // CELLS // CELLS, _cell_value(code // CELLS % CELLS), _cell_value(code % CELLS),
        1 / (rest_words + 1), n,
    )
    if not tokens:
        table[:] = 1, 0, 0

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        block = B.Block(left.column("_texts").to_pylist())
        events = Events(block, bits)
        totals = B.totals_in_order(right, 2).sum(axis=1)
        word, context, pair = totals[events.word], totals[events.context], totals[events.pair]
        weights = table[_bucket(context)]
        p = weights[:, 0] / (all_words + 1) + weights[:, 1] * word / max(tokens, 1) + weights[:, 2] * pair / np.maximum(context, 1)
        base = (word + 1) / (tokens + all_words + 1)
        add = lambda x: np.add.reduceat(x, events.starts)
        return pa.table({
            "_k1": pa.array([k[0] for k in block.keys], pa.int64()), "_k2": pa.array([k[1] for k in block.keys], pa.int64()),
            "n_tokens": events.sizes, "n_known": add((word > 0).astype(np.int64)),
            "base_score": add(np.log10(base)), "score": add(np.log10(p)),
        })

    scores = with_answers(texts, 0, score, _SCORES)
    return texts.select("_id", "_k1", "_k2").join(scores, ["_k1", "_k2"]).select(
        F.col("_id").alias(doc_id), "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )

"""Removal of long repeated byte strings by distributed prefix doubling.

Every position has a rank for the string that starts there. The pair of the ranks at a
position and at an offset is the rank of a longer string: all pairs are sorted over the
cluster and ranked anew, and positions whose rank is unique drop out. The offsets grow
from a quarter of the length to half of it; what is left then is past the threshold, a
repeat of the whole length. The first ranks are hashes that each task names for itself.

Few positions need to take part. Each window of ``length`` bytes is spoken for by the
least-hashed half-length string inside it, so equal windows are spoken for by equal
strings, and windows whose spokesman occurs once are unique from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm import blocks as B
from obslake.session import stored

U = np.uint64
PIECE = 1 << 20  # windows looked at together


def _rank(body: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit name of the string of ``length`` bytes at each position."""
    total = np.zeros(len(body) + 1, U)
    np.cumsum(B.BYTE_HASH[body] * _forward(len(body)), out=total[1:])
    ends = total[length:] - total[: len(total) - length]
    return B.mixed(ends * _backward(len(ends)))


_tables: dict[str, np.ndarray] = {}


def _table(name: str, base: int, n: int) -> np.ndarray:
    if len(_tables.get(name, ())) < n:
        _tables[name] = B.powers(base, max(n, 1 << 16))
    return _tables[name][:n]


def _forward(n: int) -> np.ndarray:
    return _table("forward", B.BASE, n)


def _backward(n: int) -> np.ndarray:
    return _table("backward", B.INVERSE, n)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, from running minima within stretches of that width."""
    padded = np.concatenate([x, np.full(-len(x) % width, np.iinfo(U).max, U)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def spokesmen(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranks of the sampled strings, and the first and last window each speaks for."""
    half, windows = -(-length // 2), len(text) - length + 1
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, max(windows, 0), PIECE):
        n = min(PIECE, windows - at)
        rank = _rank(np.frombuffer(text, np.uint8, n + length - 1, at), half)
        # Of equal hashes the leftmost speaks: which one it is depends on the window alone.
        order = rank >> U(32) << U(32) | np.arange(len(rank), dtype=U)
        who = (_sliding_least(order, length - half + 1) & U(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.diff(who, prepend=-1))
        found.append((rank[who[first]], first + at, np.append(first[1:], n) - 1 + at))
    if not found:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found))


def first_pairs(text: bytes, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """Sort keys of the strings of ``length`` bytes at all positions of the intervals.

    Each is the pair of two ranks of half that length, the second at the offset where the
    string's other half begins.
    """
    half, found = -(-length // 2), []
    for a, b in zip(first.tolist(), last.tolist()):
        for at in range(a, b + 1, PIECE):
            n = min(PIECE, b + 1 - at)
            rank = _rank(np.frombuffer(text, np.uint8, n + length - 1, at), half)
            found.append(B.chained(rank[:n], rank[length - half : length - half + n]))
    return np.concatenate(found) if found else np.zeros(0, U)


def next_pairs(
    ranks: np.ndarray, ranked: tuple[np.ndarray, np.ndarray], first: np.ndarray, last: np.ndarray, offset: int
) -> tuple[np.ndarray, np.ndarray]:
    """Sort keys of rank pairs ``offset`` apart, and which positions still have them.

    ``ranks`` holds the ranks of all positions of the ``ranked`` intervals, 0 for unique
    ones; asked for are the positions of the intervals from ``first`` to ``last``.
    """
    starts, stops = ranked
    before = np.cumsum(stops - starts + 1) - (stops - starts + 1)
    at = _positions(first, last)
    inside = np.searchsorted(starts, at, side="right") - 1
    place = before[inside] + at - starts[inside]
    a, b = ranks[place], ranks[place + offset]
    alive = (a > 0) & (b > 0)
    return B.chained(a[alive].astype(U), b[alive].astype(U)), alive


def _positions(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    sizes = last - first + 1
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first, sizes)


def joined_up(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring intervals as one."""
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > last[:-1] + 1
    starts = np.flatnonzero(new)
    return first[starts], last[np.append(starts[1:], len(first)) - 1] if len(first) else last


def covered(first: np.ndarray, last: np.ndarray, repeats: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [start, end) of bytes covered by the repeated windows."""
    at = _positions(first, last)[repeats]
    if not len(at):
        return at, at
    begin = np.ones(len(at), bool)
    begin[1:] = at[1:] > at[:-1] + length
    starts = np.flatnonzero(begin)
    return at[starts], at[np.append(starts[1:], len(at)) - 1] + length


def without(text: bytes, starts: list[int], ends: list[int]) -> bytes:
    return b"".join(text[a:b] for a, b in zip([0, *ends], [*starts, len(text)]))


_SPANS = "array<struct<start:bigint,end:bigint>>"


def repeated_spans(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400, fan: int = B.FAN
) -> DataFrame:
    """Per row: its id, n_bytes, ``spans`` (the bytes to remove, as [start, end)) and kept_sha256.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else as
    well, in the same text or another; strings never cross texts and are judged on the
    texts as given.

    Null text is empty. Texts shorter than ``length`` are kept; equal texts of at least
    that length go whole. Rows are documents, whether or not their ids are null or
    repeated; other columns do not matter. An empty table gives an empty result.
    """
    size = B.text_bytes(df, text)
    n_blocks = B.block_count(size)
    tree = B.owner_tree(n_blocks // 4, fan)
    texts = B.keyed_texts(df.select(F.col(doc_id).alias("_id"), F.col(text).alias("_x")), "_x", ["_id"])
    long = texts.where(F.octet_length("_text") >= length)
    dealt = B.dealt(long, n_blocks).groupBy("_block")
    asked_schema = pa.schema([("_owner", pa.int32()), ("_block", pa.int32()), ("_data", pa.binary())])
    asked_names = "_owner int, _block int, _data binary"
    sample_bits = B.key_bits(size / (length / 4), 14)

    def sampled(block: B.Block):
        per_text = [spokesmen(body, length) for body in block.texts]
        ranks = B.shortened(np.concatenate([p[0] for p in per_text]), sample_bits)
        return per_text, *B.distinct_keys(ranks, np.ones((len(ranks), 1), np.int64))

    def questions(number: int, keys: np.ndarray, held: np.ndarray, bits: int) -> list[tuple]:
        return [(owner, number, data) for owner, data in B.questions(keys, held.T, tree.fan, bits)]

    def table(rows: list[tuple]) -> pa.Table:
        columns = zip(*rows) if rows else [[]] * 3
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, asked_schema)], schema=asked_schema)

    def ask_sampled(blocks: pa.Table) -> pa.Table:
        _, keys, _, held = sampled(B.Block(blocks.column("_texts").to_pylist()))
        return table(questions(blocks.column("_block")[0].as_py(), keys, held, sample_bits))

    answers = B.answered(dealt.applyInArrow(ask_sampled, asked_names), tree, sample_bits)

    def remaining(left: pa.Table, right: pa.Table) -> pa.Table:
        """Texts with windows whose spokesman occurs again, with the intervals of those windows."""
        block = B.Block(left.column("_texts").to_pylist())
        out: list[tuple] = []
        if block.keys:
            per_text, _, where, _ = sampled(block)
            again = B.totals_in_order(right, 1)[where, 0] > 1
            end = 0
            for key, body, (_, first, last) in zip(block.keys, block.texts, per_text):
                mine = again[end : end + len(first)]
                end += len(first)
                if mine.any():
                    out.append((key, body, *joined_up(first[mine], last[mine])))
        if not out:
            return pa.table({"_block": pa.array([], pa.int32()), "_left": pa.array([], pa.binary())})
        keys = np.array([o[0] for o in out], np.int64)
        sizes = np.array([(len(o[1]), len(o[2])) for o in out], np.int64)
        body = np.frombuffer(b"".join(o[1] for o in out), np.uint8)
        data = [keys[:, 0], keys[:, 1], sizes[:, 0], sizes[:, 1], body, *(np.concatenate([o[i] for o in out]) for i in (2, 3))]
        return pa.table({"_block": pa.array([left.column("_block")[0].as_py()], pa.int32()), "_left": pa.array([B.packed(data)], pa.binary())})

    left = stored(
        dealt.cogroup(answers.select("_block", "_owner", "_data").groupBy("_block")).applyInArrow(
            remaining, "_block int, _left binary"
        ),
        "repeat-candidates",
    )

    def texts_left(data: bytes) -> Iterator[tuple]:
        k1, k2, n_bytes, n_spans, body, first, last = B.unpacked(data)
        whole = body.tobytes()
        ends, stops = np.cumsum(n_bytes), np.cumsum(n_spans)
        for i, key in enumerate(zip(k1.tolist(), k2.tolist())):
            spans = slice(stops[i] - n_spans[i], stops[i])
            yield key, whole[ends[i] - n_bytes[i] : ends[i]], first[spans], last[spans]

    half = -(-length // 2)
    offset = length - half

    def ones(keys: np.ndarray) -> np.ndarray:
        return np.ones((len(keys), 1), np.int64)

    def half_keys(items: list[tuple]) -> tuple:
        """The positions whose half-length ranks are needed, with their sort keys."""
        spans = [joined_up(first, last + offset) for _, _, first, last in items]
        keys = np.concatenate([first_pairs(body, *span, half) for (_, body, _, _), span in zip(items, spans)])
        return spans, *B.distinct_keys(keys, ones(keys))

    def ask_halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column("_block").to_pylist(), batch.column("_left").to_pylist()):
                _, keys, _, held = half_keys(list(texts_left(data)))
                yield from table(questions(number, keys, held, 64)).to_batches()

    def ranked(owner: int, sums: np.ndarray) -> np.ndarray:
        """New ranks in sort order, 0 for strings that occur once; no two owners give the same."""
        again = sums[:, 0] > 1
        return np.where(again, np.cumsum(again) * tree.owners + owner, 0)[:, None]

    ranks = stored(
        B.answered(left.mapInArrow(ask_halves, asked_names), tree, 64, reply=ranked).select("_block", "_owner", "_data"),
        "half-ranks",
    )

    def whole_keys(data: bytes, answers: pa.Table) -> tuple:
        """The texts, which of their windows still have two ranks, and the pairs' sort keys."""
        items = list(texts_left(data))
        spans, _, where, _ = half_keys(items)
        new = B.totals_in_order(answers, 1)[where, 0]
        found, end = [], 0
        for (_, _, first, last), span in zip(items, spans):
            n = int((span[1] - span[0] + 1).sum())
            found.append(next_pairs(new[end : end + n], span, first, last, offset))
            end += n
        keys = np.concatenate([f[0] for f in found])
        return items, [f[1] for f in found], *B.distinct_keys(keys, ones(keys))

    def ask_wholes(candidates: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for number, data in zip(candidates.column("_block").to_pylist(), candidates.column("_left").to_pylist()):
            _, _, keys, _, held = whole_keys(data, answers)
            if len(keys):
                out += questions(number, keys, held, 64)
        return table(out)

    by_block = left.groupBy("_block")
    asked = by_block.cogroup(ranks.groupBy("_block")).applyInArrow(ask_wholes, asked_names)
    repeats = B.answered(asked, tree, 64).select("_block", "_owner", "_data")
    answers = ranks.withColumn("_whole", F.lit(False)).unionByName(repeats.withColumn("_whole", F.lit(True)))
    results = pa.schema([
        ("_k1", pa.int64()), ("_k2", pa.int64()), ("_kept", pa.string()),
        ("_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ])

    def remove(candidates: pa.Table, answers: pa.Table) -> pa.Table:
        out, whole = [], answers.column("_whole")
        for data in candidates.column("_left").to_pylist():
            items, alive, _, where, _ = whole_keys(data, answers.filter(pc.invert(whole)))
            totals = B.totals_in_order(answers.filter(whole), 1)
            again = totals[where, 0] > 1 if len(where) else np.zeros(0, bool)
            end = 0
            for (key, body, first, last), living in zip(items, alive):
                n = int(living.sum())
                repeated = np.zeros(len(living), bool)
                repeated[living] = again[end : end + n]
                end += n
                starts, ends = (x.tolist() for x in covered(first, last, repeated, length))
                if starts:
                    kept = hashlib.sha256(without(body, starts, ends)).hexdigest()
                    out.append((*key, kept, [dict(start=a, end=b) for a, b in zip(starts, ends)]))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 4, results)], schema=results)

    found = by_block.cogroup(answers.groupBy("_block")).applyInArrow(
        remove, f"_k1 long, _k2 long, _kept string, _spans {_SPANS}"
    )
    copied = long.groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(
        "_k1", "_k2", F.lit(True).alias("_copied")
    )
    n_bytes = F.octet_length("_text").cast("long")
    rows = texts.select("_id", "_k1", "_k2", n_bytes.alias("n_bytes"), F.sha2("_text", 256).alias("_whole"))
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    nothing = F.array().cast(_SPANS)
    gone = F.sha2(F.lit(""), 256)
    return rows.join(found, ["_k1", "_k2"], "left").join(copied, ["_k1", "_k2"], "left").select(
        F.col("_id").alias(doc_id), "n_bytes",
        F.when(F.col("_copied"), everything).otherwise(F.coalesce("_spans", nothing)).alias("spans"),
        F.when(F.col("_copied"), gone).otherwise(F.coalesce("_kept", "_whole")).alias("kept_sha256"),
    )


def cut(df: DataFrame, spans: DataFrame, doc_id: str = "doc_id", text: str = "text", out: str = "kept_bytes") -> DataFrame:
    """``df`` with the bytes that ``spans`` (from ``repeated_spans``) leaves of each text.

    Needs unique ids. Bytes rather than text, as a span may end within a character.
    """
    body = F.encode(F.coalesce(F.col(f"_d.{text}"), F.lit("")), "UTF-8")
    edges = F.transform(F.col("_s.spans"), lambda s, i: F.struct(
        F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(F.col("_s.spans"), i - 1)["end"]).alias("a"), s["start"].alias("b")
    ))
    tail = F.struct(F.coalesce(F.element_at(F.col("_s.spans.end"), -1), F.lit(0).cast("long")).alias("a"), F.col("_s.n_bytes").alias("b"))
    whole = F.when(F.size("_s.spans") == 0, F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("_s.n_bytes").alias("b"))))
    kept = F.aggregate(
        F.coalesce(whole, F.concat(edges, F.array(tail))), F.lit(b""),
        lambda got, e: F.concat(got, F.substring(body, (e["a"] + 1).cast("int"), (e["b"] - e["a"]).cast("int"))),
    )
    own = [F.col(f"_d.`{c}`") for c in df.columns if c != out]
    return df.alias("_d").join(spans.alias("_s"), doc_id).select(*own, kept.alias(out))

"""Texts in blocks, and counts of hashed keys that every block can ask for.

Counting n-grams of a large corpus row by row moves a row per token. Here the distinct
texts are dealt to blocks of a few megabytes by their hash; a block names its distinct
keys once, sorted and delta-coded, to the task that owns their range; the owner adds up
and answers in the same order, so that an answer needs no keys. A key that occurs
everywhere costs one entry a block. No block writes to more than ``FAN`` tasks: where there
are more owners, the ranges form a tree, and inner tasks add up what some blocks hold of a
range before they ask further down, so that messages grow with the number of blocks, not
with its square. Blocks are made anew from the table when they are needed again; the same
texts give the same keys in the same order.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.words import hash_pair, text_or_empty
from obslake.llm.worker import give_back
from obslake.session import stored

BLOCK_BYTES = 6 << 20
FAN = 4096  # messages of 1 to 2 KB; each level of the tree moves all keys once more
FLUSH_BYTES = 24 << 20
U = np.uint64


# --- arrays as bytes ---------------------------------------------------------------


def packed(arrays: Sequence[np.ndarray]) -> bytes:
    """Compressed; integers by byte planes, so that zero bytes stand together."""
    body, kinds = [], []
    for a in arrays:
        a = np.ascontiguousarray(a)
        kinds.append(a.dtype.str.encode().ljust(4) + struct.pack("<q", len(a)))
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T if len(a) else a
        body.append(np.ascontiguousarray(planes).tobytes())
    raw = struct.pack("<i", len(kinds)) + b"".join(kinds) + b"".join(body)
    return struct.pack("<q", len(raw)) + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unpacked(data: bytes) -> list[np.ndarray]:
    (size,) = struct.unpack_from("<q", data)
    raw = pa.Codec("zstd").decompress(data[8:], decompressed_size=size, asbytes=True)
    (n,) = struct.unpack_from("<i", raw)
    at, found = 4 + 12 * n, []
    for i in range(n):
        kind = np.dtype(raw[4 + 12 * i : 8 + 12 * i].strip().decode())
        (length,) = struct.unpack_from("<q", raw, 8 + 12 * i)
        planes = np.frombuffer(raw, np.uint8, length * kind.itemsize, at).reshape(kind.itemsize, length)
        found.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += length * kind.itemsize
    return found


# --- hashing -----------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def chained(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a sequence of hash ``a`` followed by ``b``."""
    return mixed(a * U(0x9E3779B97F4A7C15) + b)


BASE = 0xD1342543DE82EF95
INVERSE = pow(BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
BYTE_HASH = mixed(np.arange(1, 257, dtype=U))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.ones(max(n, 1), U)
    out[1:] = base
    return np.multiply.accumulate(out)


def word_hashes(texts: Sequence[bytes], piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the texts, A-Z lower-cased, and the number of words of each text.

    Words are runs without ASCII white space. Worked off in pieces of about ``piece`` bytes.
    """
    found, counts = [], np.zeros(len(texts), np.int64)
    begin = 0
    while begin < len(texts):
        end, size = begin, 0
        while end < len(texts) and (end == begin or size + len(texts[end]) < piece):
            size += len(texts[end]) + 1
            end += 1
        b = np.frombuffer(b"\n".join(texts[begin:end]) + b"\n", np.uint8)
        space = _SPACE[b]
        edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
        first, last = edge[0::2], edge[1::2]
        if len(b) and not space[-1]:
            last = np.append(last, len(b))[: len(first)]
        total = np.zeros(len(b) + 1, U)
        np.cumsum(BYTE_HASH[_LOWER[b]] * powers(BASE, len(b)), out=total[1:])
        found.append(mixed((total[last] - total[first]) * powers(INVERSE, len(b))[first]))
        ends = np.cumsum([len(t) + 1 for t in texts[begin:end]])
        counts[begin:end] = np.diff(np.searchsorted(first, ends), prepend=0)
        begin = end
    return (np.concatenate(found) if found else np.zeros(0, U)), counts


def distinct_keys(keys: np.ndarray, weights: np.ndarray | None = None):
    """Sorted distinct keys, where each key is among them, and sums of the weights per key."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(new)
    distinct = ordered[starts]
    del ordered
    sums = weights
    if weights is not None and len(keys):
        sums = np.add.reduceat(weights[order], starts, axis=0, dtype=np.int64)
    del starts
    at = np.cumsum(new)
    at -= 1
    where = np.empty(len(keys), np.int64)
    where[order] = at
    return distinct, where, sums


# --- blocks ------------------------------------------------------------------------


def keyed_texts(df: DataFrame, text: str, columns: Sequence[str] = (), family: str | None = None) -> DataFrame:
    """``columns``, the text (null as empty) and its 128-bit hash as _k1, _k2.

    Texts of different ``family`` have different hashes.
    """
    rows = df.select(*columns, text_or_empty(text).alias("_text"))
    parts = [F.col(family), F.col("_text")] if family else [F.col("_text")]
    return rows.withColumns(hash_pair("_k", *parts))


def text_bytes(df: DataFrame, text: str) -> int:
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


def block_count(size: int) -> int:
    return max(1, math.ceil(size / BLOCK_BYTES))


def dealt(texts: DataFrame, blocks: int, weights: Sequence[str] = (), block: str | None = None) -> DataFrame:
    """Rows (_block, _texts): distinct texts with summed integer ``weights``, packed.

    Copies collapse within each batch of some megabytes before they are shuffled. A text's
    block follows from its hash, or is given by the column ``block``.
    """
    given = F.col(block) if block else F.pmod("_k1", F.lit(blocks))
    rows = texts.select(given.cast("int").alias("_block"), "_k1", "_k2", "_text", *[F.col(w).cast("long") for w in weights])

    def flush(held: dict) -> Iterator[tuple[int, bytes]]:
        by_block: dict[int, list] = {}
        for (where, k1, k2), (body, sums) in held.items():
            by_block.setdefault(where, []).append((k1, k2, body, sums))
        for where, items in by_block.items():
            keys = np.array([(k1, k2) for k1, k2, _, _ in items], np.int64).reshape(-1, 2)
            sizes = np.array([len(body) for _, _, body, _ in items], np.int64)
            body = np.frombuffer(b"".join(body for _, _, body, _ in items), np.uint8)
            sums = np.array([s for *_, s in items], np.int64).reshape(len(items), len(weights))
            yield where, packed([keys[:, 0], keys[:, 1], sizes, body, *sums.T])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        size = 0

        def out() -> pa.RecordBatch:
            rows = list(flush(held))
            return pa.record_batch(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                names=["_block", "_texts"],
            )

        for batch in batches:
            where, k1, k2 = (batch.column(i).to_pylist() for i in range(3))
            sums = list(zip(*(batch.column(4 + i).to_pylist() for i in range(len(weights))))) or [()] * len(where)
            for key, body, weight in zip(zip(where, k1, k2), batch.column(3).cast(pa.binary()).to_pylist(), sums):
                known = held.get(key)
                if known:
                    held[key] = known[0], tuple(a + b for a, b in zip(known[1], weight))
                else:
                    held[key] = body, weight
                    size += len(body)
            if size >= FLUSH_BYTES:
                yield out()
                held.clear()
                size = 0
        if held:
            yield out()

    return rows.mapInArrow(run, "_block int, _texts binary")


class Block:
    """The distinct texts of a block, in the order of their hashes."""

    def __init__(self, payloads: list[bytes]) -> None:
        held: dict[tuple[int, int], tuple[bytes, np.ndarray]] = {}
        for data in payloads:
            k1, k2, sizes, body, *sums = unpacked(data)
            whole, end = body.tobytes(), np.cumsum(sizes)
            weights = np.array(sums).T.reshape(len(k1), len(sums))
            for key, size, stop, weight in zip(zip(k1.tolist(), k2.tolist()), sizes.tolist(), end.tolist(), weights):
                known = held.get(key)
                held[key] = (known[0], known[1] + weight) if known else (whole[stop - size : stop], weight)
        self.keys = sorted(held)
        self.texts = [held[k][0] for k in self.keys]
        self.weights = np.array([held[k][1] for k in self.keys], np.int64).reshape(len(self.keys), -1)


# --- asking for counts -------------------------------------------------------------


def shortened(keys: np.ndarray, bits: int) -> np.ndarray:
    """The upper ``bits`` bits of 64-bit keys."""
    return keys >> U(64 - bits)


def key_bits(entries: float, spare: int) -> int:
    """Bits at which a key meets a foreign one among so many with a chance of 2^-spare."""
    return min(64, max(24, math.ceil(math.log2(max(entries, 2))) + spare))


class Tree(NamedTuple):
    """Ranges of keys, each cut into ``fan`` smaller ones, ``depth`` times; the smallest have owners."""

    fan: int
    depth: int

    @property
    def owners(self) -> int:
        return self.fan**self.depth


def owner_tree(owners: int, fan: int = FAN) -> Tree:
    """At least so many owners, under nodes of at most ``fan`` children that are about equal in number."""
    depth = 1
    while fan**depth < owners:
        depth += 1
    least = next(n for n in range(1, owners + 1) if n**depth >= owners) if depth > 1 else max(1, owners)
    return Tree(least, depth)


def questions(
    keys: np.ndarray, values: Sequence[np.ndarray], ranges: int, bits: int, first: int = 0, of: int | None = None
) -> Iterator[tuple[int, bytes]]:
    """Sorted distinct shortened keys with their values, per range of keys.

    All keys lie in ``ranges`` ranges from number ``first`` on, out of ``of``, or of these alone.
    """
    edges = [(i << bits) // (of or ranges) for i in range(first + 1, first + ranges)]
    cuts = np.concatenate([[0], np.searchsorted(keys, np.array(edges, U)), [len(keys)]]).astype(np.int64)
    for at in range(ranges):
        a, b = cuts[at], cuts[at + 1]
        if a < b:
            part = keys[a:b]
            yield first + at, packed([part[:1], np.diff(part), *[_narrow(v[a:b]) for v in values]])


def _narrow(values: np.ndarray) -> np.ndarray:
    """The smallest unsigned type that holds the values."""
    largest = int(values.max(initial=0))
    return values.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if largest <= np.iinfo(t).max))


_ASKED = "_owner int, _block int, _data binary"
_ASKED_SCHEMA = pa.schema([("_owner", pa.int32()), ("_block", pa.int32()), ("_data", pa.binary())])
_ANSWER = "_block int, _owner int, _data binary, _summary array<long>"
_ANSWER_SCHEMA = pa.schema(
    [("_block", pa.int32()), ("_owner", pa.int32()), ("_data", pa.binary()), ("_summary", pa.list_(pa.int64()))]
)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _added_up(payloads: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """How many keys each payload has, the distinct keys, where each key is among them, and their sums."""
    keys, values = [], []
    for data in payloads:
        first, steps, *counts = unpacked(data)
        keys.append(np.cumsum(np.concatenate([first, steps]), dtype=U))
        values.append(np.array(counts).T.reshape(len(keys[-1]), len(counts)))
    sizes = [len(k) for k in keys]
    keys, values = np.concatenate(keys), np.concatenate(values)  # the parts may go before all are sorted
    return sizes, *distinct_keys(keys, values)


def _replies(blocks: list[int], owner: int, sizes: list[int], where: np.ndarray, sent: np.ndarray) -> list[tuple]:
    out, at = [], 0
    for block, size in zip(blocks, sizes):
        out.append((block, owner, packed([_narrow(column) for column in sent[where[at : at + size]].T]), None))
        at += size
    return out


def _asked_further(asked: DataFrame, tree: Tree, level: int, bits: int) -> DataFrame:
    """What ``fan`` askers want to know of a range, added up and asked of the ranges within it."""

    def ask(table: pa.Table) -> pa.Table:
        node, herd = table.column("_owner")[0].as_py(), table.column("_herd")[0].as_py()
        _, keys, _, sums = _added_up(table.column("_data").to_pylist())
        inner = questions(keys, sums.T, tree.fan, bits, node * tree.fan, tree.fan ** (level + 1))
        return _table([(owner, herd, data) for owner, data in inner], _ASKED_SCHEMA)

    return asked.groupBy("_owner", "_herd").applyInArrow(ask, _ASKED)


def _handed_back(asked: DataFrame, answers: DataFrame, tree: Tree) -> DataFrame:
    """Answers to what was asked further, dealt to those that had asked."""

    def hand(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table([], _ANSWER_SCHEMA)
        sizes, _, where, sums = _added_up(left.column("_data").to_pylist())
        sent = totals_in_order(right, sums.shape[1])
        return _table(
            _replies(left.column("_block").to_pylist(), left.column("_owner")[0].as_py(), sizes, where, sent), _ANSWER_SCHEMA
        )

    inner = answers.where("_data IS NOT NULL").select(
        F.floor(F.col("_owner") / tree.fan).cast("int").alias("_node"), F.col("_block").alias("_herd"), "_owner", "_data"
    )
    back = asked.groupBy("_owner", "_herd").cogroup(inner.groupBy("_node", "_herd")).applyInArrow(hand, _ANSWER)
    return back.unionByName(answers.where("_data IS NULL"))


def answered(
    asked: DataFrame,
    tree: Tree,
    bits: int,
    summary: Callable[[np.ndarray, np.ndarray], tuple[int, ...]] | None = None,
    reply: Callable[[int, np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """Add up the values of equal keys and send every block the totals of the keys it asked for.

    ``asked`` has rows (_owner, _block, _data) for the first ``tree.fan`` ranges of keys of
    ``bits`` bits. The answer has rows (_block, _owner, _data); ``reply`` turns an owner's
    number and totals, in the order of its keys, into what is sent instead of the totals; with
    ``summary``, a row of block -1 per owner holds numbers over all its keys.
    """

    def add_up(table: pa.Table) -> pa.Table:
        owner = table.column("_owner")[0].as_py()
        sizes, distinct, where, sums = _added_up(table.column("_data").to_pylist())
        out = _replies(table.column("_block").to_pylist(), owner, sizes, where, reply(owner, sums) if reply else sums)
        if summary:
            out.append((-1, owner, None, summary(distinct, sums)))
        del distinct, where, sums
        give_back()
        return _table(out, _ANSWER_SCHEMA)

    levels = []
    for level in range(1, tree.depth):
        herd = F.floor(F.col("_block") / tree.fan).cast("int")
        levels.append(stored(asked.withColumn("_herd", herd), "asked"))
        asked = _asked_further(levels[-1], tree, level, bits)
    answers = asked.groupBy("_owner").applyInArrow(add_up, _ANSWER)
    for above in reversed(levels):
        answers = _handed_back(above, stored(answers, "answers"), tree)
    return answers


def totals_in_order(answers: pa.Table, columns: int) -> np.ndarray:
    """A block's answers as one row of totals per key, in the order of its keys."""
    rows = sorted(zip(answers.column("_owner").to_pylist(), answers.column("_data").to_pylist()))
    parts = [np.array(unpacked(data), np.int64).T for _, data in rows]
    return np.concatenate(parts) if parts else np.zeros((0, columns), np.int64)

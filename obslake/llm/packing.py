"""Best-fit packing of token pieces into sequences of a fixed capacity.

Texts are tokenised in Arrow batches and cut into pieces of at most ``capacity`` tokens.
What a packing needs to know is how many pieces there are of each length, at most
``capacity`` numbers; from these the driver plans which lengths share a sequence:
first Martello and Toth's dominance reduction fixes small sets that provably lose
nothing, then best fit places what is left. The pieces themselves stay in Spark: they
are numbered per length and look their place up in the plan.
"""

from __future__ import annotations

import bisect
import os
import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.worker import give_back, memory
from obslake.llm.words import text_or_empty
from obslake.session import stored

CACHED_WORDS = 200_000  # a Python worker
HANDED_ON = 1 << 18  # tokens of pieces that are handed on together
END = b"\0\0\0\0"
MARKS = b".,!?;:"


# --- planning over lengths ---------------------------------------------------------


@dataclass
class Run:
    """``count`` pieces of one length, ``each`` of them side by side in every sequence."""

    length: int
    each: int
    offset: int
    first: int  # number of the first piece among those of this length


@dataclass
class Bins:
    """``count`` sequences with the same content."""

    count: int
    used: int
    runs: list[Run]


class _Lengths:
    """Pieces not yet placed, by length, in order."""

    def __init__(self, counts: Mapping[int, int]) -> None:
        self.left = {length: n for length, n in counts.items() if n}
        self.sorted = sorted(self.left)
        self.taken: Counter[int] = Counter()

    def largest_up_to(self, room: int) -> int | None:
        at = bisect.bisect_right(self.sorted, room)
        return self.sorted[at - 1] if at else None

    def smallest_sum(self, n: int, without: int) -> float:
        """Sum of the n smallest pieces when one of length ``without`` is already used."""
        total = 0
        for length in self.sorted:
            there = min(n, self.left[length] - (length == without))
            total, n = total + there * length, n - there
            if not n:
                return total
        return float("inf")

    def take(self, length: int, n: int) -> int:
        first = self.taken[length]
        self.taken[length] += n
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
            self.sorted.remove(length)
        return first


def _companions(lengths: _Lengths, item: int, capacity: int) -> tuple[int, ...] | None:
    """A set that together with ``item`` dominates every other feasible set, if one is found.

    Alone, when nothing fits beside it. With the largest piece that fits, when that
    fills the sequence, or no two pieces fit, or any two that fit are no longer than it
    together. With two pieces, when at most two fit and the largest with its best
    partner is at least as long, member by member, as any other pair.
    """
    room = capacity - item
    if lengths.smallest_sum(1, item) > room:
        return ()
    best = lengths.largest_up_to(room)
    if best == item and lengths.left[item] == 1:
        best = lengths.largest_up_to(item - 1)
    if best is None:
        return ()
    if best == room or lengths.smallest_sum(2, item) > room:
        return (best,)
    if lengths.smallest_sum(3, item) <= room:
        return None
    spare = {length: lengths.left[length] - (length == item) for length in lengths.sorted if length <= room}
    spare = {length: n for length, n in spare.items() if n}

    def partner(length: int) -> int:
        limit = min(room - length, length)
        return max((x for x in spare if x <= limit and spare[x] > (x == length)), default=0)

    partners = {length: partner(length) for length in spare}
    if all(not p or length + p <= best for length, p in partners.items()):
        return (best,)
    second = partners[best]
    if second and all(p <= second or length + p <= best for length, p in partners.items()):
        return (best, second)
    return None


def reduce_by_dominance(lengths: _Lengths, capacity: int) -> list[Bins]:
    """Fix sets that dominate; the instance shrinks, some optimal packing is still reachable."""
    fixed: list[Bins] = []
    item = lengths.sorted[-1] if lengths.sorted else None
    while item is not None:
        while item in lengths.left:
            found = _companions(lengths, item, capacity)
            if found is None:
                break
            members = Counter((item, *found))
            # The same set goes on dominating while its members last: the rest only shrinks.
            times = min(lengths.left[length] // n for length, n in members.items())
            runs, offset = [], 0
            for length, n in sorted(members.items(), reverse=True):
                runs.append(Run(length, n, offset, lengths.take(length, n * times)))
                offset += n * length
            fixed.append(Bins(times, offset, runs))
        item = lengths.largest_up_to(item - 1)
    return fixed


def best_fit(lengths: _Lengths, capacity: int) -> list[Bins]:
    """Best fit in decreasing length; equal sequences are filled together."""
    rooms: list[int] = []
    open_bins: dict[int, list[Bins]] = defaultdict(list)
    full: list[Bins] = []

    def keep(group: Bins) -> None:
        room = capacity - group.used
        if not room:
            full.append(group)
            return
        if not open_bins[room]:
            bisect.insort(rooms, room)
        open_bins[room].append(group)

    for length in sorted(lengths.left, reverse=True):
        left = lengths.left[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                group = open_bins[room].pop()
                if not open_bins[room]:
                    rooms.pop(at)
            else:
                room, group = capacity, None
            each = room // length
            bins = left // each if group is None else min(group.count, left // each)
            if not bins:  # one sequence takes what is left of this length
                bins, each = 1, left
            runs, used = (group.runs, group.used) if group else ([], 0)
            if group and group.count > bins:
                # The sequences that stay as they are keep the later pieces of each run.
                rest = [Run(r.length, r.each, r.offset, r.first + bins * r.each) for r in runs]
                keep(Bins(group.count - bins, used, rest))
            run = Run(length, each, used, lengths.take(length, bins * each))
            keep(Bins(bins, used + each * length, [*runs, run]))
            left -= bins * each
    return full + [group for groups in open_bins.values() for group in groups]


def plan(counts: Mapping[int, int], capacity: int) -> list[Bins]:
    """A packing of ``counts[length]`` pieces of each length."""
    lengths = _Lengths(counts)
    return reduce_by_dominance(lengths, capacity) + best_fit(lengths, capacity)


def places(bins: list[Bins]) -> dict[int, np.ndarray]:
    """Per length the runs in order of their first piece: first, sequence, each, offset."""
    found: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    sequence = 0
    for group in bins:
        for run in group.runs:
            found[run.length].append((run.first, sequence, run.each, run.offset))
        sequence += group.count
    return {length: np.array(sorted(runs), dtype=np.int64) for length, runs in found.items()}


# --- tokenising --------------------------------------------------------------------



def _tokenizer(path: str) -> tuple:
    """The tokenizer, the ids of words seen so far, and the spellings of special tokens."""
    kept = memory("tokenizers")
    if path not in kept:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        special = [t.content.lower().encode() for t in tokenizer.get_added_tokens_decoder().values()]
        kept[path] = tokenizer, {}, special
    return kept[path]


def _ids(encoding) -> bytes:
    return array("I", encoding.ids).tobytes()


def _learn(tokenizer, cache: dict[bytes, bytes], words: list[bytes]) -> None:
    """Add the ids of new words; ASCII marks after an ASCII letter or digit are words of their own."""
    parts = {w: (base, w[len(base) :]) for w in words if (base := w.rstrip(MARKS)) != w and base[-1:].isalnum()}
    wanted = {x for w in words for x in parts.get(w, (w,))}
    new = list(wanted.difference(cache))
    found = tokenizer.encode_batch_fast([w.decode("utf-8") for w in new], add_special_tokens=False)
    cache.update(zip(new, map(_ids, found)))
    cache.update((w, cache[base] + cache[tail]) for w, (base, tail) in parts.items())


def token_bytes(text: str, path: str, cached_words: int = CACHED_WORDS) -> bytes:
    """The ids of a text as little-endian unsigned 32-bit integers.

    The tokenizer lower-cases, splits at white space and drops it, so a text's ids are
    those of its words in a row; words seen before are looked up. Texts that spell a
    special token are handed over whole.
    """
    tokenizer, cache, special = _tokenizer(path)
    raw = text.encode("utf-8", "replace").lower()
    if any(s in raw for s in special):
        return _ids(tokenizer.encode(text, add_special_tokens=False))
    words = raw.split()
    missing = list(set(words).difference(cache))
    if len(cache) + len(missing) > cached_words:
        cache.clear()
        missing = list(set(words))
    if missing:
        _learn(tokenizer, cache, missing)
    return b"".join(map(cache.__getitem__, words))


_PIECES = (
    "_id long, piece int, start long, length long, ids_crc32 long, ids binary, _part int, _nth long, _row long"
)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, with_ids: bool, cached_words: int):
    part, seen, row = TaskContext.get().partitionId(), Counter(), 0
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64())
    names = [f.split()[0] for f in _PIECES.split(", ")]

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out) if out else [()] * len(kinds)
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for batch in batches:
        out, tokens = [], 0
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            body = token_bytes(text.as_py(), path, cached_words) + END
            for number, start in enumerate(range(0, len(body), 4 * capacity)):
                ids = body[start : start + 4 * capacity]
                length = len(ids) // 4
                out.append((doc, number, start // 4, length, zlib.crc32(ids), ids if with_ids else None, part, seen[length], row))
                seen[length] += 1
                row += 1
                tokens += length
            if tokens >= HANDED_ON:
                yield rows(out)
                out, tokens = [], 0
        yield rows(out)
        out = None
        give_back()


def pack(
    df: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    with_ids: bool = True,
    cached_words: int = CACHED_WORDS,
) -> DataFrame:
    """Per piece: its id column, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document is its token ids and then id 0, so that null or empty text is one token.
    Only documents longer than ``capacity`` are cut. Sequence numbers are any numbers;
    within a sequence the pieces lie side by side from 0.

    Ids are handed through as they are, null and repeated ones too (each row is a
    document); other columns do not matter. An empty table gives an empty result.
    ``tokenizer_path`` must be readable where tasks run. ``cached_words`` trades a Python
    worker's memory for time: so many words keep their ids.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("_id"), text_or_empty(text).alias("_text"))
    pieces = stored(
        rows.mapInArrow(lambda batches: _pieces(batches, tokenizer_path, capacity, with_ids, cached_words), _PIECES),
        "pieces",
    )
    per_part = pieces.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    # At most ``capacity`` rows reach the driver.
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    table = places(plan(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select(
        "length", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    # Ids never pass through Python again: places are found for numbers and joined to them.
    own = [] if with_ids else [F.col("_id").alias(doc_id), "piece", "start", "ids_crc32"]
    numbered = pieces.join(before, ["length", "_part"]).select(
        *own, "length", "_part", "_row", (F.col("_before") + F.col("_nth")).alias("_number")
    )

    def place(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("_number").to_numpy()
            sequence, offset = np.empty_like(number), np.empty_like(number)
            for one in np.unique(length):
                mine = np.flatnonzero(length == one)
                runs = table[int(one)]
                run = runs[np.searchsorted(runs[:, 0], number[mine], side="right") - 1]
                nth = number[mine] - run[:, 0]
                sequence[mine] = run[:, 1] + nth // run[:, 2]
                offset[mine] = run[:, 3] + nth % run[:, 2] * one
            kept = batch.drop_columns(["_number"])
            names = [*kept.schema.names, "sequence_id", "offset"]
            yield pa.record_batch([*kept.columns, pa.array(sequence), pa.array(offset)], names=names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema if f.name != "_number"]
    placed = numbered.mapInArrow(place, ", ".join([*fields, "sequence_id long", "offset long"]))
    if not with_ids:
        return placed.drop("_part", "_row")
    return pieces.join(placed.drop("length"), ["_part", "_row"]).select(
        F.col("_id").alias(doc_id), "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"
    )

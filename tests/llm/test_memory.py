"""What task functions hold at once, in bytes of their input."""

from __future__ import annotations

import tracemalloc

import numpy as np

from obslake.llm import blocks as B
from obslake.llm import near_duplicates as N


def peak(f) -> int:
    f()
    tracemalloc.start()
    try:
        f()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def some_texts(n: int) -> list[bytes]:
    draw = np.random.default_rng(7).integers(0, 5000, (n, 300))
    return [b" ".join(b"word%d" % w for w in row) for row in draw.tolist()]


def test_shingles_of_a_block_take_little_more_than_the_result():
    texts = some_texts(1500)
    assert peak(lambda: N.shingle_sets(texts, 5)) < 6 * sum(map(len, texts))


def test_shingle_sets_do_not_depend_on_the_pieces():
    texts = [b"", *some_texts(20), b"one two", b" \n", b"a b c d e f g " * 900, b"", *some_texts(2)]
    whole = N.shingle_sets(texts, 5, 1 << 30)
    for piece in (1, 700, 5000):
        found = N.shingle_sets(texts, 5, piece)
        assert all(a.dtype == b.dtype and a.tolist() == b.tolist() for a, b in zip(whole, found))
    assert [len(x) for x in N.shingle_sets([], 5)] == [0, 0]


def test_adding_up_what_blocks_hold_takes_few_bytes_a_key():
    rng = np.random.default_rng(3)
    keys = [np.unique(rng.integers(0, 1 << 40, 300_000, dtype=np.uint64)) for _ in range(2)]
    keys.append(keys[0])
    counts = [np.arange(len(k)) % (2 + 300 * i) for i, k in enumerate(keys)]
    sent = [B.packed([k[:1], np.diff(k), B._narrow(n)]) for k, n in zip(keys, counts)]
    total = sum(map(len, keys))
    assert peak(lambda: B._added_up(sent)) < 56 * total
    sizes, distinct, where, sums = B._added_up(sent)
    assert sizes == [len(k) for k in keys] and sums.dtype == np.int64
    assert distinct.tolist() == sorted({*keys[0].tolist(), *keys[1].tolist()})
    expected = np.zeros(len(distinct), np.int64)
    np.add.at(expected, where, np.concatenate(counts))
    assert sums[:, 0].tolist() == expected.tolist()
    assert (distinct[where] == np.concatenate(keys)).all()

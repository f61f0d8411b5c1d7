"""Best-fit packing: the plan, the tokens, and the places."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from obslake.llm import packing
from obslake.llm.registry import registered
from tests.conftest import SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


def sequences(counts: dict[int, int], capacity: int) -> int:
    """Check that every piece has its own place, and count the sequences."""
    bins = packing.plan(counts, capacity)
    table, used = packing.places(bins), defaultdict(list)
    for length, count in counts.items():
        runs = table[length]
        for i in range(count):
            first, sequence, each, offset = runs[np.searchsorted(runs[:, 0], i, side="right") - 1]
            used[sequence + (i - first) // each].append((offset + (i - first) % each * length, length))
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(used) == sum(b.count for b in bins)
    return len(used)


def fewest(items: tuple[int, ...], capacity: int) -> int:
    """Exhaustive search."""
    best = len(items)

    def place(i: int, rooms: list[int]) -> None:
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= items[i]}.values():
            place(i + 1, [r - items[i] if j == k else r for j, r in enumerate(rooms)])
        place(i + 1, [*rooms, capacity - items[i]])

    place(0, [])
    return best


def test_plan_is_sound_and_close_to_the_optimum():
    extra = 0
    for seed in range(150):
        rng = random.Random(seed)
        items = tuple(sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 9))), reverse=True))
        extra += sequences(dict(Counter(items)), 20) - fewest(items, 20)
    assert extra <= 3


def test_reduction_never_loses():
    """What dominance fixes, together with the best packing of the rest, is an optimum."""
    for seed in range(120):
        rng = random.Random(seed)
        items = tuple(sorted((rng.randint(3, 20) for _ in range(rng.randint(1, 9))), reverse=True))
        lengths = packing._Lengths(Counter(items))
        fixed = sum(b.count for b in packing.reduce_by_dominance(lengths, 20))
        rest = tuple(sorted(Counter(lengths.left).elements(), reverse=True))
        assert fixed + (fewest(rest, 20) if rest else 0) == fewest(items, 20), items


def test_many_equal_pieces():
    counts = {2048: 1000, 1024: 77, 1: 5000, 700: 12345, 3: 999}
    assert sequences(counts, 2048) >= -(-sum(k * n for k, n in counts.items()) // 2048)


def test_words_in_a_row_are_the_text():
    tokenizer = Tokenizer.from_file(PATH)
    for text in ["İstanbul ΟΔΟΣ 𝒜 é ́x", "don't it's 12ab, c.d. end!!", "\x1c\x1da\x85b", "a ́b!", "", "“x”, y”.",
                 "<|startoftext|> z <|endoftext|>", "A<|STARTOFTEXT|>b", "tab\tand\nline "]:
        wanted = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert packing.token_bytes(text, PATH) == wanted, text


def check(rows, texts):
    tokenizer = Tokenizer.from_file(PATH)
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(pieces[doc_id], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [r["length"] for r in own[:-1]] == [2048] * (len(own) - 1)
        at = 0
        for r in own:
            assert r["start"] == at and zlib.crc32(ids[at : at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 2048
    return len(places)


def test_query(spark, texts):
    rows = registered()["op1_pack"](spark, SMALL).collect()
    n = check(rows, texts)
    assert n <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_odd_tables(spark, odd, empty):
    rows = packing.pack(odd, PATH).collect()
    assert sum(r["piece"] == 0 for r in rows) == odd.count()
    assert {r["doc_id"]: r["length"] for r in rows if r["doc_id"] in (2, 3, 4)} == {2: 1, 3: 1, 4: 1}
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
    assert packing.pack(empty, PATH).collect() == []

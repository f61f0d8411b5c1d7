"""Cheapest edits of a row of conversation turns, by blocks of turns looked up in tables.

A turn is one of ten symbols: its role and whether it is cut off, or that it must go. What
the rest of a conversation costs is a vector over the four states of the grammar
``(s?(ua)+)?``. Less its smallest entry there are few such vectors, so a table holds for
every block of symbols and every vector behind it the vector before it, and the state in
which each entry state leaves the block. Blocks are looked up from the last to the first;
going forward again, a block is expanded turn by turn and each edit is the ASCII-least one
that the costs allow.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

import numpy as np

START, SYSTEM, USER, ASSISTANT = range(4)
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ADDED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ENDS = (START, ASSISTANT)
NOTHING, MUST_GO, FIRST_ROLE = 0, 1, 2
INITIALS = "suax"
SYMBOLS = FIRST_ROLE + 2 * len(INITIALS)


def symbol(initial: str, cut_off: bool) -> int:
    return FIRST_ROLE + 2 * INITIALS.index(initial) + cut_off


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    cut_off: int = 5  # a kept turn without an end


@dataclass
class Edited:
    """What became of a stretch of turns."""

    fates: list[str]  # per turn: roles inserted before it, its edit, its new role
    tail: str  # roles inserted behind the last turn
    cost: int
    state: int


class Tables:
    """Transitions of normalised cost vectors over every block of ``length`` symbols."""

    def __init__(self, costs: Costs, length: int) -> None:
        self.costs, self.length = costs, length
        self.vectors = [self._closed([0 if s in ENDS else None for s in range(4)])[0]]
        numbers, steps = {self.vectors[0]: 0}, []
        for vector in self.vectors:  # grows while it is read
            row = []
            for sign in range(SYMBOLS):
                before, least = self._closed([self._cheapest(sign, s, vector) for s in range(4)])
                if before not in numbers:
                    numbers[before] = len(numbers)
                    self.vectors.append(before)
                row.append((numbers[before], least))
            steps.append(row)
        self.end, self.size = 0, len(self.vectors)
        self.before = np.array([[steps[v][x][0] for v in range(self.size)] for x in range(SYMBOLS)])
        self._least = [[steps[v][x][1] for v in range(self.size)] for x in range(SYMBOLS)]
        self._turns = [[[self._turn(x, v, s) for s in range(4)] for v in range(self.size)] for x in range(SYMBOLS)]
        self.leaves = np.array([[[t[1] for t in row] for row in rows] for rows in self._turns])
        self._expanded: dict[tuple[int, int, int], tuple] = {}

    def _closed(self, vector: list[int | None]) -> tuple[tuple[int, ...], int]:
        """With insertions, less the smallest entry; and that entry."""
        big = 10**6
        found = [big if x is None else x for x in vector]
        for _ in range(4):
            for s, role in ADDED.items():
                found[s] = min(found[s], self.costs.insert + found[KEPT[s, role]])
        return tuple(x - min(found) for x in found), min(found)

    def _options(self, sign: int, state: int) -> list[tuple[str, int, int]]:
        """Edits of one turn in ASCII order: letter with the new role, cost, next state."""
        if sign == NOTHING:
            return [("", 0, state)]
        options = [("D", self.costs.delete, state)]
        if sign != MUST_GO:
            initial, cut_off = INITIALS[(sign - FIRST_ROLE) // 2], (sign - FIRST_ROLE) % 2 * self.costs.cut_off
            if (state, initial) in KEPT:
                options.append(("K", cut_off, KEPT[state, initial]))
            if ADDED[state] != initial:
                options.append(("R" + ADDED[state], self.costs.rerole + cut_off, KEPT[state, ADDED[state]]))
        return options

    def _cheapest(self, sign: int, state: int, behind: tuple[int, ...]) -> int:
        return min(cost + behind[after] for _, cost, after in self._options(sign, state))

    def _turn(self, sign: int, behind: int, state: int) -> tuple[str, int, int]:
        """Fate of a turn, the state behind it and its cost: the ASCII-least of the cheapest."""
        fate, spent, least = "", 0, self._least[sign][behind]
        here = [x + least for x in self.vectors[self.before[sign][behind]]]
        while True:
            options = self._options(sign, state)
            cheapest = [o for o in options if o[1] + self.vectors[behind][o[2]] == here[state]]
            insert = KEPT[state, ADDED[state]]
            if self.costs.insert + here[insert] == here[state] and not (cheapest and cheapest[0][0] in ("", "D")):
                fate, spent, state = fate + ADDED[state], spent + self.costs.insert, insert
                continue
            edit, cost, after = cheapest[0]
            return fate + edit, after, spent + cost

    @cached_property
    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """For each block and vector behind it: the vector before it, and the states it is left in."""
        before, leaves = np.arange(self.size)[None, :], np.tile(np.arange(4), (1, self.size, 1))
        for _ in range(self.length):
            inner = np.broadcast_to(before, (SYMBOLS, *before.shape))
            first = np.arange(SYMBOLS)[:, None, None]
            through = self.leaves[first, inner]
            leaves = np.take_along_axis(np.broadcast_to(leaves, (SYMBOLS, *leaves.shape)), through, axis=-1)
            leaves = leaves.reshape(-1, self.size, 4)
            before = self.before[first, inner].reshape(-1, self.size)
        return before, leaves

    @cached_property
    def _listed(self) -> list[list[int]]:
        return self.blocks[0].tolist()

    def cut(self, signs: bytes) -> np.ndarray:
        """The turns' symbols (ASCII digits) as numbers of blocks; the last is filled with nothing."""
        digits = np.frombuffer(signs, np.uint8).astype(np.int64) - ord("0")
        digits = np.concatenate([digits, np.full(-len(digits) % self.length, NOTHING)])
        return digits.reshape(-1, self.length) @ SYMBOLS ** np.arange(self.length)[::-1]

    def stretch(self, signs: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For every vector behind the turns: the vector before them, the states they are left in."""
        before, leaves = np.arange(self.size), np.tile(np.arange(4), (self.size, 1))
        for block in self.cut(signs)[::-1]:
            leaves = np.take_along_axis(leaves, self.blocks[1][block][before], axis=1)
            before = self.blocks[0][block][before]
        return before, leaves

    def _expand(self, block: int, behind: int, state: int) -> tuple[list[str], int, int]:
        """A block turn by turn: fates, the state it is left in, cost."""
        key = (block, behind, state)
        if key not in self._expanded:
            signs, vectors = [], []
            for _ in range(self.length):
                block, sign = divmod(block, SYMBOLS)
                signs.append(sign)
                vectors.append(behind)
                behind = int(self.before[sign][behind])
            fates, cost = [], 0
            for sign, vector in zip(signs[::-1], vectors[::-1]):
                fate, state, spent = self._turns[sign][vector][state]
                if sign != NOTHING:
                    fates.append(fate)
                cost += spent
            self._expanded[key] = fates, state, cost
        return self._expanded[key]

    def edit(self, signs: bytes, behind: int = 0, state: int = START, last: bool = True) -> Edited:
        """Edits of a stretch entered in ``state``, the vector ``behind`` it being known."""
        vectors, blocks = [], self.cut(signs).tolist()
        for block in reversed(blocks):
            vectors.append(behind)
            behind = self._listed[block][behind]
        out = Edited([], "", 0, state)
        for block, vector in zip(blocks, reversed(vectors)):
            fates, out.state, cost = self._expand(block, vector, out.state)
            out.fates += fates
            out.cost += cost
        while last and out.state not in ENDS:
            role = ADDED[out.state]
            out.tail, out.state, out.cost = out.tail + role, KEPT[out.state, role], out.cost + self.costs.insert
        return out


def audit(fates: Iterable[str], copies: Iterable[int], tail: str) -> str:
    """The edits' initials; further copies of a turn are deleted."""
    letters = []
    for fate, n in zip(fates, copies):
        edit = fate.lstrip("sua")
        letters.append("I" * (len(fate) - len(edit)) + edit[0] + "D" * (n - 1))
    return "".join(letters) + "I" * len(tail)

"""Toxicity from a learned lexicon that also catches misspelled terms.

Terms and word stems that toxic training documents share and clean ones lack, by a test
that allows for how many were tried, make a trie. A word's Levenshtein automaton, kept as
bit sets of positions, is intersected with the trie; branches without a live state are
cut. A hit's window of words tells quotation from abuse. The lexicon comes from one part
of the training documents; on another, to which misspelled copies of its toxic documents
are added, a logistic regression learns what hits are worth. None can lower a score, and
neither an edit nor a quotation can make a hit worth more.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obslake.llm.blocks import chained, word_hashes
from obslake.llm.words import widened
from obslake.llm.worker import memory
from obslake.session import stored

CACHED_WORDS = 400_000
COUNTED_TOGETHER = 200  # documents whose terms a task holds at a time
WORDS = re.compile(r"[^\W\d_]+")
# Words with digits or marks between their letters, as in 'stup1d': one word, and also its parts.
MIXED = re.compile(r"[^\W\d_]+(?:[\d@$!*|]+[^\W\d_]+)+")
SPANS = re.compile(r"[^\W\d_]+(?:[\d@$!*|]+[^\W\d_]+)*")
# ASCII bytes that are no letters become spaces; what else parts words is found per word.
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
STEMS = range(4, 10)
SURROUNDINGS = 3  # in which an entry is seen at least: fewer, and it belongs to a text that is often repeated
FEATURES = ("exact", "exact_quoted", "fuzzy", "fuzzy_quoted")
# Marks and words that announce a quotation.
QUOTES = "\"“”„«»‹›‘’"
REPORTING = frozenset(
    "said says wrote called quoted quote word term sagte schrieb nannte zitat wort "
    "dijo escribió llamó cita palabra dit écrit appelé citation mot".split()
)


@dataclass
class Node:
    children: dict[str, Node] = field(default_factory=dict)
    term: str | None = None  # a whole word ends here
    stem: str | None = None  # any word may go on from here


def build_trie(terms: Sequence[str], stems: Sequence[str]) -> Node:
    root = Node()
    for words, kind in ((terms, "term"), (stems, "stem")):
        for word in words:
            node = root
            for letter in word:
                node = node.children.setdefault(letter, Node())
            setattr(node, kind, word)
    return root


def match(word: str, root: Node, fuzzy_from: int, stems_from: int | None = None) -> tuple[str, int] | None:
    """The closest lexicon entry within one edit and the number of edits, or None.

    Bit i of ``exact`` (``off``) says that i letters of the word are read without (with)
    an edit. Terms shorter than ``fuzzy_from`` and stems shorter than ``stems_from`` count
    only without an edit.
    """
    stems_from = fuzzy_from if stems_from is None else stems_from
    masks: dict[str, int] = {}
    for i, letter in enumerate(word):
        masks[letter] = masks.get(letter, 0) | 1 << i
    end = 1 << len(word)
    best: tuple[str, int] | None = None
    stack = [(root, 1, 2)]
    while stack:
        node, exact, off = stack.pop()
        for entry, reached, least in ((node.term, end, fuzzy_from), (node.stem, -1, stems_from)):
            if entry is None:
                continue
            if exact & reached:
                return entry, 0
            if off & reached and len(entry) >= least and best is None:
                best = entry, 1
        for letter, child in node.children.items():
            mask = masks.get(letter, 0)
            step = (exact & mask) << 1
            # With one edit: a letter replaced, missing from the word, or too many in it.
            edited = ((off & mask) << 1 | exact << 1 | exact | step << 1) & (2 * end - 1)
            if step or edited:
                stack.append((child, step, edited))
    return best


@dataclass(frozen=True)
class ToxicityModel:
    terms: tuple[str, ...]
    stems: tuple[str, ...]
    weights: tuple[float, ...]  # of FEATURES, then the intercept
    fuzzy_from: int = 4
    window: int = 6
    worth: tuple[float, ...] = ()  # of the terms, then the stems; 1 where it is not given
    known: frozenset[str] = frozenset()  # words of clean documents that are an edit away from an entry
    stems_from: int = 10


class _Matcher:
    """Matches words, remembering what it has seen."""

    def __init__(self, model: ToxicityModel) -> None:
        self.root = build_trie(model.terms, model.stems)
        self.model = model
        self.stems = frozenset(model.stems)
        entries = (*model.terms, *model.stems)
        self.worth = dict(zip(entries, model.worth or (1.0,) * len(entries)))
        self.terms = frozenset(model.terms)
        self.stem_lengths = sorted({len(stem) for stem in model.stems})
        # Within one edit of an entry, its first or its second half is intact and hardly moved.
        self.heads: dict[int, set] = {}
        self.ends: dict[int, set] = {}
        self.tails: dict[tuple[int, int], set] = {}
        for term in model.terms:
            if len(term) >= model.fuzzy_from:
                half = len(term) // 2
                for length in range(len(term) - 1, len(term) + 2):
                    self.heads.setdefault(half, set()).add((term[:half], length))
                    self.ends.setdefault(len(term) - half, set()).add((term[half:], length))
        self.stem_heads: dict[int, set] = {}
        for stem in model.stems:
            if len(stem) >= model.stems_from:
                half = len(stem) // 2
                self.stem_heads.setdefault(half, set()).add(stem[:half])
                self.tails.setdefault((half, len(stem) - half), set()).add(stem[half:])
        self.seen: set[bytes] = set()
        self.found: dict[bytes, dict[str, tuple[int, float]]] = {}

    def _near(self, word: str) -> bool:
        """Whether an intersection with the trie can find an entry one edit away."""
        n = len(word)
        if any((word[:half], n) in known for half, known in self.heads.items()):
            return True
        if any((word[n - half :], n) in known for half, known in self.ends.items()):
            return True
        if any(word[:half] in known for half, known in self.stem_heads.items()):
            return True
        return any(
            word[at : at + size] in known for (half, size), known in self.tails.items() for at in (half - 1, half, half + 1)
        )

    def hit(self, word: str) -> tuple[int, float] | None:
        """Edits and worth of the entry that a word matches."""
        if word in self.terms:
            return 0, self.worth[word]
        for n in self.stem_lengths:
            if word[:n] in self.stems:
                return 0, self.worth[word[:n]]
        if word in self.model.known or not self._near(word):
            return None
        found = match(word, self.root, self.model.fuzzy_from, self.model.stems_from)
        return found and (found[1], self.worth[found[0]])

    def hits(self, lower: str) -> dict[str, tuple[int, float]]:
        """The words of a text that match, with their edits and worth."""
        distinct = set(lower.encode("utf-8", "replace").translate(_LETTERS).split())
        distinct.update(w.encode("utf-8", "replace") for w in MIXED.findall(lower))
        new = distinct.difference(self.seen)
        if len(self.seen) + len(new) > CACHED_WORDS:
            self.seen.clear()
            self.found.clear()
            new = distinct
        self.seen |= new
        for raw in new:
            word = raw.decode("utf-8")
            words = [word] if MIXED.fullmatch(word) else WORDS.findall(word)
            own = {w: hit for w in words if (hit := self.hit(w))}
            if own:
                self.found[raw] = own
        matched: dict[str, tuple[int, float]] = {}
        for raw in distinct & self.found.keys():
            matched |= self.found[raw]
        return matched


def _spans(lower: str, hits: Mapping[str, tuple[int, float]]) -> list[re.Match]:
    """The words in order; one with inner marks is a word if it matches, else its parts are."""
    found: list[re.Match] = []
    for span in SPANS.finditer(lower):
        if span[0] in hits or not MIXED.fullmatch(span[0]):
            found.append(span)
        else:
            found.extend(WORDS.finditer(lower, span.start(), span.end()))
    return found


def _features(text: str | None, matcher: _Matcher, window: int) -> tuple[float, ...]:
    """Logs of the worth of exact and fuzzy hits, as abuse and within quotation."""
    sums = dict.fromkeys(FEATURES, 0.0)
    lower = (text or "").lower()
    hits = matcher.hits(lower)
    if hits:
        spans = _spans(lower, hits)
        for i, span in enumerate(spans):
            if span[0] not in hits:
                continue
            edits, worth = hits[span[0]]
            first, last = spans[max(0, i - window)], spans[min(len(spans) - 1, i + window)]
            before, after = lower[first.start() : span.start()], lower[span.end() : last.end()]
            cues = any(q in before for q in QUOTES) and any(q in after for q in QUOTES)
            near = {s[0] for s in spans[max(0, i - window) : i + window + 1]}
            quoted = "_quoted" if cues or near & REPORTING else ""
            sums[("fuzzy" if edits else "exact") + quoted] += worth
    return tuple(float(np.log1p(sums[name])) for name in FEATURES)


def misspelled(text: str, matcher: _Matcher) -> str | None:
    """The first matched term with a letter changed, left out or put in; None without one.

    It stands alone: one misspelled term has to be enough. The edit follows from the term,
    so that a lost task makes the same again.
    """
    lower = text.lower()
    least = matcher.model.fuzzy_from
    hits = {w for w, (edits, _) in matcher.hits(lower).items() if not edits and w in matcher.terms and len(w) >= least}
    if not hits:
        return None
    word = min(hits, key=lambda w: (lower.index(w), w))
    mark = zlib.crc32(word.encode())
    at, kind = 1 + mark // 3 % (len(word) - 2), mark % 3
    return word[:at] + ("", word[at] * 2, "1")[kind] + word[at + 1 :]


def _likeness(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row the least hash over all stretches of five words, or over the words of a shorter text."""
    for batch in batches:
        least = []
        for value in batch.column("_text"):
            words, _ = word_hashes([(value.as_py() or "").encode("utf-8", "replace")])
            stretches = words[: max(0, len(words) - 4)]
            for k in range(1, 5):
                stretches = chained(stretches, words[k : k + len(stretches)])
            stretches = stretches if len(stretches) else words
            least.append(int(stretches.min(initial=np.iinfo(np.uint64).max).view(np.int64)))
        yield pa.record_batch([*batch.columns, pa.array(least, pa.int64())], names=["_toxic", "_text", "_like"])


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label and part that hold each word or stem; a stem ends in '*'.

    ``around`` marks, one bit of 64 each, what two words stand before it in toxic documents.
    """
    groups = [(toxic, first) for first in (True, False) for toxic in (0, 1)]

    def rows(found: dict[tuple, Counter], around: dict[str, int]) -> pa.RecordBatch:
        terms = list(set().union(*found.values()))
        columns = [pa.array(terms, pa.string()), *(pa.array([found[g][t] for t in terms], pa.int64()) for g in groups)]
        columns.append(pa.array(np.array([around.get(t, 0) for t in terms], np.uint64).view(np.int64)))
        return pa.record_batch(columns, names=["term", "clean", "toxic", "clean_later", "toxic_later", "around"])

    for batch in batches:
        for at in range(0, batch.num_rows, COUNTED_TOGETHER):
            found, around = {g: Counter() for g in groups}, {}
            part = batch.slice(at, COUNTED_TOGETHER)
            for toxic, text, first in zip(part.column(0).to_pylist(), part.column(1), part.column(2).to_pylist()):
                in_order = WORDS.findall((text.as_py() or "").lower())
                words = set(in_order)
                found[toxic, first].update(words)
                found[toxic, first].update({w[:n] + "*" for w in words for n in STEMS if len(w) >= n})
                before = zip(["", "", *in_order], ["", *in_order], in_order) if toxic and first else ()
                for far, near, word in before:
                    bit = 1 << zlib.crc32(f"{far} {near}".encode()) % 64
                    around[word] = around.get(word, 0) | bit
                    for n in STEMS:
                        if len(word) >= n:
                            around[word[:n] + "*"] = around.get(word[:n] + "*", 0) | bit
            yield rows(found, around)


def _significant(pairs: list, of_toxic: int, of_clean: int, rate: float) -> float:
    """The least log-likelihood ratio at which no more than ``rate`` of the terms are there by chance.

    ``pairs`` are rows (toxic, clean, terms with these counts): Benjamini and Hochberg's step-up rule.
    """
    share = of_toxic / (of_toxic + of_clean)

    def ratio(toxic: int, clean: int) -> float:
        both = toxic + clean
        return 2 * sum(n * math.log(n / (both * p)) for n, p in ((toxic, share), (clean, 1 - share)) if n)

    rising = [(ratio(t, c), n) for t, c, n in pairs if t * of_clean > c * of_toxic]
    tried, better, level = sum(n for *_, n in pairs), 0, math.inf
    for value, n in sorted(rising, reverse=True):
        better += n
        if math.erfc(math.sqrt(value / 2)) <= rate * better / tried:
            level = value
    return level


def _lexicon(counts: Mapping[str, int], least: float, entries: int) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Whole words, and the longest stems that keep nearly all documents of shorter ones.

    The ``entries`` in most documents are kept, counted once stems are merged.
    """
    stems = {t[:-1]: n for t, n in counts.items() if t.endswith("*")}
    words = {t: n for t, n in counts.items() if not t.endswith("*")}
    longer: dict[str, list[str]] = {}
    for stem in stems:
        longer.setdefault(stem[:-1], []).append(stem)
    begun: dict[str, list[str]] = {}
    for word in words:
        for n in STEMS:
            if len(word) >= n:
                begun.setdefault(word[:n], []).append(word)
    kept_stems, kept_words = {}, {}

    def covered(word: str) -> bool:
        return any(word[:n] in kept_stems for n in STEMS)

    for stem in sorted(stems, key=len):
        if covered(stem):
            continue
        n, best = stems[stem], stem
        while more := [s for s in longer.get(best, ()) if stems[s] >= 0.9 * n]:
            best = more[0]
        whole = [w for w in begun.get(best, ()) if words[w] >= 0.9 * n]
        if whole:
            word = min(whole, key=len)
            kept_words[word] = words[word]
        else:
            kept_stems[best] = stems[best]
    kept_words |= {w: n for w, n in words.items() if n >= least and not covered(w)}
    found = [(-n, w, kind) for kind, kept in enumerate((kept_words, kept_stems)) for w, n in kept.items()]
    most = sorted(found)[:entries]
    return tuple(tuple(sorted(w for _, w, k in most if k == kind)) for kind in (0, 1))


def _fit(features: np.ndarray, labels: np.ndarray, ridge: float = 0.05, rounds: int = 4000) -> np.ndarray:
    """Logistic regression under 0 <= quoted <= unquoted and fuzzy <= exact; both labels weigh the same.

    The order of the weights holds by construction: they are sums of parts that are not
    negative, and each step puts parts below zero back to it.
    """
    exact, exact_quoted, fuzzy, fuzzy_quoted = features.T
    # Parts: of all hits, of unquoted ones, of exact ones, of exact unquoted ones.
    parts = np.stack([exact + exact_quoted + fuzzy + fuzzy_quoted, exact + fuzzy, exact + exact_quoted, exact], axis=1)
    x = np.hstack([parts, np.ones((len(parts), 1))])
    weigh = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum())) * 1000
    step = 1 / (np.linalg.eigvalsh((x * weigh[:, None]).T @ x / 4)[-1] + ridge)
    w = ahead = np.zeros(x.shape[1])
    for i in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        new = ahead - step * (x.T @ (weigh * (p - labels)) + ridge * ahead)
        new[:-1] = np.maximum(new[:-1], 0)
        ahead, w = new + (i / (i + 3)) * (new - w), new
    every, unquoted, spelled, both = w[:-1]
    return np.array([every + unquoted + spelled + both, every + spelled, every + unquoted, every, w[-1]])


def train(
    df: DataFrame,
    labels: DataFrame | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    sample: int = 6000,
    entries: int = 512,
    least_docs: int = 5,
    least_share: float = 0.001,
    odds: float = 5.0,
    chance: float = 0.05,
    fuzzy_from: int = 4,
    window: int = 6,
    stems_from: int = 10,
) -> ToxicityModel:
    """Lexicon and weights from at most ``sample`` rows of each label, chosen by a hash of the id.

    ``df`` holds ids and texts, ``labels`` ids and 0/1 labels (by default ``df`` does);
    rows with a null label are left out. An entry is in ``least_docs`` toxic rows and in
    ``least_share`` of them. Two thirds of the rows give the lexicon: there it is ``odds`` times as
    frequent there as in clean ones, and so uneven that at most a share ``chance`` of the
    entries is expected to be so by accident; it follows on three different pairs of words,
    and in the other third it is no rarer in toxic rows than in clean ones (an entry of twice as many
    rows need not be there). Stems have 4 to 9 letters. Of what is left once stems are merged, the ``entries`` in most rows are
    kept. The last third gives the weights. Misspelled terms count from ``fuzzy_from``
    letters on, unless a clean row has the misspelled word; stems from ``stems_from``, by
    default never: too many words begin nearly like them.
    Without both labels every score is the share of toxic rows.
    """
    marked = (df if labels is None else labels).where(F.col(toxic).isNotNull()).select(
        F.col(doc_id).alias("_id"), (F.col(toxic) > 0).cast("int").alias("_toxic")
    )
    drawn = [
        marked.where(F.col("_toxic") == label).orderBy(F.xxhash64("_id"), "_id").limit(sample).distinct()
        for label in (0, 1)
    ]
    # At most twice ``sample`` ids: small enough to send to every task, so no text is shuffled.
    ids = F.broadcast(drawn[0].unionByName(drawn[1]))
    texts = df.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    # Copies and most near copies have the same least hash of five words: one of them counts,
    # else every word of a text that is often repeated would look like a sign of its label.
    drawn_texts = texts.join(ids, "_id").select("_toxic", "_text").mapInArrow(_likeness, "_toxic int, _text string, _like long")
    single = drawn_texts.groupBy("_toxic", "_like").agg(F.min("_text").alias("_text"))
    part = F.pmod(F.xxhash64(F.lit(3), "_like"), F.lit(3)) < 2
    chosen = stored(single.select("_toxic", "_text", part.alias("_first")), "toxicity-sample")
    sizes = {(r["_toxic"], r["_first"]): r["n"] for r in chosen.groupBy("_toxic", "_first").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, bad = (sum(sizes.get((label, x), 0) for x in (True, False)) for label in (0, 1))
    if not clean or not bad:
        share = bad / max(1, clean + bad)
        level = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return ToxicityModel((), (), (0.0,) * len(FEATURES) + (level,), fuzzy_from, window, stems_from=stems_from)
    of_toxic, of_clean = max(1, sizes.get((1, True), 0)), max(1, sizes.get((0, True), 0))
    least = max(least_docs, least_share * bad)
    tried = stored(
        chosen.mapInArrow(_term_counts, "term string, clean long, toxic long, clean_later long, toxic_later long, around long")
        .groupBy("term")
        .agg(*[F.sum(c).alias(c) for c in ("clean", "toxic", "clean_later", "toxic_later")], F.bit_or("around").alias("around"))
        .where((F.col("toxic") + F.col("toxic_later") >= least) & (F.bit_count("around") >= SURROUNDINGS)),
        "toxicity-candidates",
    )
    pairs = tried.groupBy("toxic", "clean").agg(F.count(F.lit(1)).alias("n")).select("toxic", "clean", "n").collect()
    level = _significant([tuple(r) for r in pairs], of_toxic, of_clean, chance)
    later = [max(1, sizes.get((label, False), 0)) for label in (0, 1)]
    share = of_toxic / (of_toxic + of_clean)
    both = F.col("toxic") + F.col("clean")
    odd = lambda n, p: F.when(n > 0, n * F.log(n / (both * F.lit(p)))).otherwise(0.0)
    counts = (
        tried.where(
            (F.col("toxic") * of_clean >= F.lit(odds) * of_toxic * (F.col("clean") + 0.5))
            & (2 * (odd(F.col("toxic"), share) + odd(F.col("clean"), 1 - share)) >= F.lit(level * (1 - 1e-9)))
            & ((F.col("toxic_later") > 0) | (F.col("toxic") >= 2 * least))
            & (F.col("toxic_later") * later[0] >= later[1] * F.col("clean_later"))
        )
        .orderBy(F.col("toxic").desc(), "term")
        .collect()
    )
    terms, stems = _lexicon({r["term"]: r["toxic"] + r["toxic_later"] for r in counts}, least, entries)
    # What a hit is worth: 1 for an entry with the highest odds, less the closer they are to even.
    log_odds = {r["term"]: float(np.log((r["toxic"] + 0.5) / of_toxic * of_clean / (r["clean"] + 0.5))) for r in counts}
    most = max(log_odds.values(), default=1.0)
    worth = tuple(log_odds.get(t, log_odds.get(t + "*", most)) / most for t in terms) + tuple(log_odds[t + "*"] / most for t in stems)
    bare = ToxicityModel(terms, stems, (0.0,) * (len(FEATURES) + 1), fuzzy_from, window, worth, stems_from=stems_from)

    def close_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words of clean rows that are an edit away from an entry."""
        matcher, found = _Matcher(bare), {}
        for batch in batches:
            for mine, value in zip(batch.column(1).to_pylist(), batch.column(0)):
                found |= {(w, mine): 0 for w, (edits, _) in matcher.hits((value.as_py() or "").lower()).items() if edits}
        yield pa.record_batch({"word": pa.array([w for w, _ in found], pa.string()), "first": pa.array([f for _, f in found], pa.bool_())})

    close = chosen.where("_toxic = 0").select("_text", "_first").mapInArrow(close_words, "word string, first boolean").distinct().collect()
    # The weights are learned as if the second part's words were not known: new texts will have such words.
    early = replace(bare, known=frozenset(r["word"] for r in close if r["first"]))
    rest = chosen.where("NOT _first").select("_toxic", "_text")
    seen = rest.mapInArrow(_scorer(early, 1, features=True), "_toxic int, _features array<double>").toPandas()
    weights = _fit(np.array(seen["_features"].tolist()).reshape(-1, len(FEATURES)), seen["_toxic"].to_numpy(float))
    return replace(bare, weights=tuple(map(float, weights)), known=frozenset(r["word"] for r in close))


def _scorer(model: ToxicityModel, at: int, features: bool = False, names: Sequence[str] = ()):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = memory("toxicity")
        if model not in matchers:
            matchers.clear()
            matchers[model] = _Matcher(model)
        matcher, weights = matchers[model], np.array(model.weights)
        for batch in batches:
            texts = batch.column(at)
            found = [_features(t.as_py(), matcher, model.window) for t in texts]
            if features:
                toxic = batch.column(0).to_pylist()
                for label, one in zip(batch.column(0).to_pylist(), texts):
                    wrong = misspelled(one.as_py() or "", matcher) if label else None
                    if wrong is not None:
                        toxic.append(label)
                        found.append(_features(wrong, matcher, model.window))
                columns = [pa.array(toxic, pa.int32()), pa.array(found, pa.list_(pa.float64()))]
                yield pa.record_batch(columns, names=["_toxic", "_features"])
                continue
            x = np.hstack([np.array(found).reshape(-1, len(FEATURES)), np.ones((len(found), 1))])
            score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            new = [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.record_batch([*batch.columns, *new], names=[*batch.schema.names, *names])

    return run


def score_documents(
    df: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score", predicted: str = "predicted"
) -> DataFrame:
    """``df`` with the score (0 to 1) of each whole text and 1 where it is at least 0.5.

    Null and empty texts have no hit and get the score of a clean text. Columns with the
    names of the new ones are replaced.
    """
    own = [c for c in df.columns if c not in (score, predicted)]
    run = _scorer(model, own.index(text), names=(score, predicted))
    return widened(df, own, run, StructType.fromDDL(f"`{score}` double, `{predicted}` int"))

"""Near duplicates by Jaccard similarity of word shingles, with adaptive prefixes.

Documents with equal shingle sets are one node. Shingles are ordered by how many texts
hold them, rarest first. Two similar sets share at least l shingles within their
prefixes of length n - ceil(s * n) + l, for every l; each node takes the l with the least
estimated cost, and a pair becomes a candidate when it shares min(l, l') of the prefix
shingles. Only shingles that more than one text holds can be shared, so only they leave
the blocks.

What counts is which documents hang together, so a posting list is first compared with
its most central node alone; a pair that is connected by then needs no look.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm import blocks as B
from obslake.llm.components import components
from obslake.llm.worker import give_back
from obslake.session import stored

U = np.uint64
VERIFY = 16  # cost of comparing two sets, in posting entries
LONGEST = 8  # largest number of shared prefix shingles asked for
PIECE = 1 << 18  # bytes of text whose shingles are made together


def shingle_sets(texts: list[bytes], words: int, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one text after the other, and set sizes.

    Worked off in pieces of about ``piece`` bytes, as the arrays in between take much more
    memory than the result.
    """
    found, sizes, begin = [np.zeros(0, U)], [np.zeros(0, np.int64)], 0
    while begin < len(texts):
        end, held = begin, 0
        while end < len(texts) and (end == begin or held + len(texts[end]) < piece):
            held += len(texts[end])
            end += 1
        some, size = _sets_of(texts[begin:end], words)
        found.append(some)
        sizes.append(size)
        begin = end
    return np.concatenate(found), np.concatenate(sizes)


def _sets_of(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    hashed, counts = B.word_hashes(texts)
    sizes = np.where(counts == 0, 0, np.maximum(counts - words + 1, 1))
    starts = np.cumsum(counts) - counts
    of = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[of]
    length = np.minimum(counts, words)[of]
    code = B.mixed(length.astype(U) + U(0x51ED270B))
    for k in range(words):
        inside = k < length
        code[inside] = B.chained(code[inside], hashed[at[inside] + k])
    order = np.lexsort((code, of))
    code, of = code[order], of[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (of[1:] != of[:-1])
    return code[new], np.bincount(of[new], minlength=len(texts))


def prefix_choice(rarity: np.ndarray, percent: int) -> int:
    """The l with the least estimated cost for a set whose shingles' counts are given, ascending.

    Scanning costs the entries of the prefix's posting lists; of these, a share of about
    1 / l meets a partner often enough to be compared.
    """
    n = len(rarity)
    least = -(-percent * n // 100)
    lists = np.cumsum(rarity - 1)
    choices = np.arange(1, min(LONGEST, least) + 1)
    entries = lists[n - least + choices - 1].astype(float)
    return int(choices[np.argmin(entries * (1 + VERIFY / choices))])


def has_room(x: str, y: str) -> Column:
    """Whether a shingle in both prefixes may be the first of as many as a pair must share there.

    From it on, both prefixes must hold that many. The end of a prefix, with its most common
    shingles, so brings no pair together.
    """
    return F.least(f"{x}._left", f"{y}._left") >= F.least(f"{x}._l", f"{y}._l")


def _described(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Per document the size of its shingle set and a 128-bit hash of the set."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            shingles, sizes = shingle_sets(part.column("_text").cast(pa.binary()).to_pylist(), words)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            marks = []
            for seed in (1, 2):
                sums = np.concatenate([np.zeros(1, U), np.cumsum(B.mixed(shingles + U(seed)), dtype=U)])
                marks.append(B.chained(sums[ends[1:]] - sums[ends[:-1]], sizes.astype(U)).view(np.int64))
            columns = [*part.columns[:3], pa.array(sizes, pa.int64()), *map(pa.array, marks)]
            yield pa.record_batch(columns, names=["_id", "_k1", "_k2", "_n", "_s1", "_s2"])
        give_back()


def _rows(schema: pa.Schema, columns: list) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def near_duplicate_groups(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    out_size: str = "n_shingles",
    out_group: str = "component_id",
    fan: int = B.FAN,
) -> DataFrame:
    """Per row: its id, the size of its shingle set, and the smallest id it is linked with.

    Words are runs without ASCII white space, A-Z lower-cased; the set holds the distinct
    shingles of ``words`` words, or the whole sequence if it is shorter. Two documents are
    linked when the intersection is at least ``percent`` % of the union.

    Null or wordless text has an empty set and is linked with nothing; its row names its
    own id. Rows with a null id are left out; rows that share an id are one document as
    far as links go. Other columns do not matter. An empty table gives an empty result.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_x")).where("_id IS NOT NULL")
    size = B.text_bytes(rows, "_x")
    n_blocks = B.block_count(size)
    tree, bits = B.owner_tree(n_blocks // 2, fan), B.key_bits(size / 6, 14)
    texts = B.keyed_texts(rows, "_x", ["_id"])
    dealt = B.dealt(texts, n_blocks).groupBy("_block")

    documents = stored(
        texts.select("_id", "_k1", "_k2", "_text").mapInArrow(
            lambda batches: _described(batches, words), "_id long, _k1 long, _k2 long, _n long, _s1 long, _s2 long"
        ),
        "shingle-documents",
    )

    # How many texts hold each shingle?
    asked_schema = pa.schema([("_owner", pa.int32()), ("_block", pa.int32()), ("_data", pa.binary())])

    def ask(table: pa.Table) -> pa.Table:
        number = table.column("_block")[0].as_py()
        shingles, _ = shingle_sets(B.Block(table.column("_texts").to_pylist()).texts, words)
        keys, _, held = B.distinct_keys(B.shortened(shingles, bits), np.ones((len(shingles), 1), np.int64))
        asked = [(owner, number, data) for owner, data in B.questions(keys, held.T, tree.fan, bits)]
        del shingles, keys, held
        give_back()
        return _rows(asked_schema, list(zip(*asked)) if asked else [[]] * 3)

    answers = B.answered(dealt.applyInArrow(ask, "_owner int, _block int, _data binary"), tree, bits)

    # One node per set: the smallest id, and one text to read the shingles from.
    nodes = documents.where("_n > 0").groupBy("_s1", "_s2").agg(F.min(F.struct("_id", "_k1", "_k2")).alias("_first"))
    read = nodes.select(
        F.pmod("_first._k1", F.lit(n_blocks)).cast("int").alias("_block"), F.lit(None).cast("int").alias("_owner"),
        F.lit(None).cast("binary").alias("_data"), "_first._k1", "_first._k2", F.col("_first._id").alias("_node"),
    )
    no_node = [F.lit(None).cast("long").alias(c) for c in ("_k1", "_k2", "_node")]
    told = answers.select("_block", "_owner", "_data", *no_node).unionByName(read)

    profile_schema = pa.schema([
        ("_node", pa.int64()), ("_n", pa.int64()), ("_m", pa.int64()), ("_l", pa.int32()), ("_central", pa.float64()),
        ("_prefix", pa.list_(pa.int64())), ("_shared", pa.list_(pa.int64())),
    ])

    def profile(left: pa.Table, right: pa.Table) -> pa.Table:
        """Nodes that hold a shared shingle in their prefix."""
        block = B.Block(left.column("_texts").to_pylist())
        owned = right.filter(right.column("_owner").is_valid())
        node_rows = right.filter(right.column("_node").is_valid())
        node_of = dict(zip(zip(node_rows.column("_k1").to_pylist(), node_rows.column("_k2").to_pylist()), node_rows.column("_node").to_pylist()))
        shingles, sizes = shingle_sets(block.texts, words)
        _, where, _ = B.distinct_keys(B.shortened(shingles, bits))
        totals = B.totals_in_order(owned, 1)
        count = totals[where, 0] if len(where) else np.zeros(0, np.int64)
        out, end = [], 0
        for key, n in zip(block.keys, sizes.tolist()):
            mine, held = shingles[end : end + n], count[end : end + n]
            end += n
            if key not in node_of or not n:
                continue
            order = np.lexsort((mine, held))
            mine, held = mine[order], held[order]
            shared, least = held > 1, -(-percent * n // 100)
            if shared.sum() >= least:  # else no set holds enough of its shingles
                choice = prefix_choice(held, percent)
                length = n - least + choice
                prefix = mine[:length][shared[:length]]
                out.append((node_of[key], n, int(shared.sum()), choice, float(np.log(held).sum() / n), prefix.view(np.int64), mine[shared].view(np.int64)))
        table = _rows(profile_schema, list(zip(*out)) if out else [[]] * 7)
        del block, shingles, where, totals, count, out
        give_back()
        return table

    profiles = stored(
        dealt.cogroup(told.groupBy("_block")).applyInArrow(
            profile, "_node long, _n long, _m long, _l int, _central double, _prefix array<long>, _shared array<long>"
        ),
        "shingle-profiles",
    )
    postings = profiles.select(
        "_node", "_n", "_m", "_l", "_central", F.size("_prefix").alias("_length"), F.posexplode("_prefix").alias("_at", "_token")
    )
    shared_by = postings.groupBy("_token").agg(F.min("_node").alias("_low"), F.max("_node").alias("_high"))
    postings = stored(
        postings.join(shared_by.where("_low <> _high").select("_token"), "_token"), "shingle-postings"
    )

    def compared(pairs: DataFrame) -> DataFrame:
        """Candidate pairs (_a, _b) with the sizes of both sets and of their intersection."""
        sides = [profiles.select(F.col("_node").alias(c), F.col("_n").alias(c + "n"), F.col("_shared").alias(c + "s")) for c in ("_a", "_b")]
        both = F.size(F.array_intersect("_as", "_bs")).cast("long")
        joined = pairs.join(sides[0], "_a").join(sides[1], "_b")
        return joined.select("_a", "_b", "_an", "_bn", both.alias("_both"))

    similar = F.col("_both") * 100 >= (F.col("_an") + F.col("_bn") - F.col("_both")) * percent

    def may_link(x: str, y: str) -> Column:
        """Whether both sets have enough shared shingles for an intersection of the size it takes."""
        needed = (F.col(f"{x}._n") + F.col(f"{y}._n")) * percent
        return F.least(f"{x}._m", f"{y}._m", f"{x}._n", f"{y}._n") * (100 + percent) >= needed

    def in_reach(x: str, y: str) -> Column:
        """Whether a common shingle stands where it can in two similar sets.

        As both sets are in the same order, they share no more shingles before it than the
        shorter of both beginnings holds, and from it on no more than the shorter of both ends.
        """
        rests = [F.col(f"{side}._m") - F.col(f"{side}._at") for side in (x, y)]
        most = F.least(f"{x}._at", f"{y}._at") + F.least(*rests)
        return most * (100 + percent) >= (F.col(f"{x}._n") + F.col(f"{y}._n")) * percent

    # Every node against the most central node it shares a posting list with.
    centre = postings.groupBy("_token").agg(F.max(F.struct("_central", "_node", "_n", "_m", "_at")).alias("_c"))
    centre = centre.select("_token", "_c.*")
    star = (
        postings.alias("x").join(centre.alias("y"), "_token")
        .where((F.col("x._node") != F.col("y._node")) & in_reach("x", "y"))
        .groupBy("x._node", F.col("y._node").alias("_b"), "y._central")
        .agg(F.count(F.lit(1)).alias("_times"))
        .groupBy(F.col("_node").alias("_a"))
        .agg(F.max(F.struct("_times", "_central", "_b")).alias("_best"))
        .select("_a", "_best._b")
    )
    star = stored(compared(star), "star-pairs")
    star_links = star.where(similar).select("_a", "_b")
    together = stored(components(star_links), "star-components")

    # All other candidate pairs: of each list, only nodes of different components meet.
    known = star.select(F.col("_a").alias("_node"), F.col("_b").alias("_centre"), F.col("_both").alias("_with"))
    placed = postings.join(together, "_node", "left").join(known, "_node", "left").select(
        "_token", "_at", "_node", "_n", "_m", "_l", (F.col("_length") - F.col("_at")).alias("_left"),
        F.coalesce("_component", "_node").alias("_component"),
        F.coalesce("_centre", "_node").alias("_centre"), F.coalesce("_with", "_m").alias("_with"),
    )
    placed = stored(placed, "placed-postings")

    different = F.col("x._component") != F.col("y._component")
    # two nodes outside the major component would meet twice
    once = (F.col("y._component") == F.col("y._major")) | (F.col("x._node") < F.col("y._node"))
    pair = [F.least("x._node", "y._node").alias("_a"), F.greatest("x._node", "y._node").alias("_b")]

    def beside_major(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """Rows of keys with several components, and those of them outside the key's largest one."""
        parts = (
            rows.groupBy(key, "_component").agg(F.count(F.lit(1)).alias("_nodes"))
            .groupBy(key).agg(F.max(F.struct("_nodes", "_component")).alias("_most"), F.count(F.lit(1)).alias("_parts"))
            .where("_parts > 1").select(key, F.col("_most._component").alias("_major"))
        )
        meeting = rows.join(parts, key)
        return meeting, meeting.where(F.col("_component") != F.col("_major"))

    # Nodes compared with the same centre: the intersection is at most what both share with
    # it and what either shares with anyone beyond it.
    beyond = [F.col(f"{side}._m") - F.col(f"{side}._with") for side in "xy"]
    most = F.least("x._with", "y._with") + F.least(*beyond)
    enough = most * (100 + percent) >= (F.col("x._n") + F.col("y._n")) * percent
    around, few = beside_major(placed.drop("_token", "_at", "_l", "_left").distinct(), "_centre")
    near = (
        few.alias("x").join(around.alias("y"), "_centre")
        .where(different & once & may_link("x", "y") & enough)
        .select(*pair)
    )
    # Nodes of different centres meet in posting lists, where there is room; before the first
    # shingle of their prefixes that they share, the sets share nothing.
    listed, few = beside_major(placed, "_token")
    rests = [F.col(f"{side}._m") - F.col(f"{side}._at") for side in "xy"]
    far = (
        few.alias("x").join(listed.alias("y"), "_token")
        .where(different & once & in_reach("x", "y") & (F.col("x._centre") != F.col("y._centre")) & has_room("x", "y"))
        .groupBy(*pair)
        .agg(F.max(F.least(*rests)).alias("_most"), F.max(F.col("x._n") + F.col("y._n")).alias("_sum"))
        .where(F.col("_most") * (100 + percent) >= F.col("_sum") * percent)
        .select("_a", "_b")
    )
    met = near.unionByName(far)
    links = star_links.unionByName(compared(met).where(similar).select("_a", "_b"))
    grouped = components(links)

    full = documents.where("_n > 0")
    nodes = full.groupBy("_s1", "_s2").agg(F.min("_id").alias("_node"))
    groups = nodes.join(grouped, "_node", "left").select(
        "_s1", "_s2", F.coalesce("_component", "_node").alias("_group")
    )
    linked = full.join(groups, ["_s1", "_s2"]).select("_id", "_n", "_group")
    alone = documents.where("_n = 0").select("_id", "_n", F.col("_id").alias("_group"))
    return linked.unionByName(alone).select(
        F.col("_id").alias(doc_id), F.col("_n").alias(out_size), F.col("_group").alias(out_group)
    )

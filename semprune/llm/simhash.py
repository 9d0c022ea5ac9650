"""Near copies by SimHash: all fingerprints within a few bits of each other, linked exactly.

A fingerprint has 64 bits; a bit is set if more than half of the shingle hashes have it. Fingerprints link if they differ in
at most ``budget`` bits. They then agree wholly on at least one
of ``budget + 1`` blocks, so a fingerprint goes, once for each block, to the binary trie whose first bits are that block. Inside a trie,
pairs of nodes go down together, from both roots to the leaves, adding up the bits in which they
differ; a pair beyond the budget is dropped with all below it. A pair of nodes whose leaves are
already one component needs no visit, so that a crowd of near copies costs no pair of its own.

Equal fingerprints are one leaf: copies never meet each other. A task returns a spanning forest of
what it linked, and components are the closure of all forests. A trie far larger than the average is
cut into tiles, each pair of tiles a task of its own.

Defined cases: a missing text is empty; a text without words has fingerprint zero; with fewer words than a
shingle, the whole sequence is the shingle. Ids may be null or repeated: each row has its result, and a
component is named by its smallest id. Texts are read whole. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semprune.llm.common import broadcast_if_small
from semprune.session import materialize

SHINGLE_WORDS = 4
SEED = 42
BUDGET = 4
#: A trie is cut into tiles beyond this many leaves, and beyond a multiple of the average.
TILE_LEAVES = 4096
TILE_AVERAGES = 8
#: Pairs of nodes with at most so many pairs of leaves are compared leaf by leaf.
FEW_PAIRS = 64
#: Pairs of nodes, and pairs of leaves, that a task holds at once.
FRONTIER = 1 << 17
LEAF_PAIRS = 1 << 19


# --- fingerprints ----------------------------------------------------------------------------


def shingle_hashes(text: str | None, size: int) -> list[int]:
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return []
    if len(words) <= size:
        return [xxh64_intdigest(b" ".join(words), SEED)]
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    begins = [0, *ends[: len(words) - size]]
    return [xxh64_intdigest(line[a : b - 1], SEED) for a, b in zip(begins, ends[size - 1 :], strict=True)]


def fingerprint(hashes: list[int] | np.ndarray) -> int:
    """Bits that over half of the hashes have."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    packed = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    for at in range(0, len(packed), 1 << 16):
        counts += np.unpackbits(packed[at : at + (1 << 16)], axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(shingle_hashes(t.as_py(), size)) for t in batch.column(1)], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["id", "print"])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", size: int = SHINGLE_WORDS) -> DataFrame:
    """(id, print): each row's fingerprint, as a signed 64-bit number."""
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _fingerprints(b, size), "id long, print long")


def as_hex(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


# --- trie join -------------------------------------------------------------------------------


def blocks(budget: int) -> list[tuple[int, int]]:
    """(first bit, bits) of ``budget + 1`` blocks, counted from the highest bit."""
    n = budget + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Component labels (smallest index) after linking i and j."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return label
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label[label] != label).any():
            label = label[label]


def _leaf_pairs(a0, a1, b0, b1) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of leaves of the given pairs of nodes."""
    wide, n = b1 - b0, (a1 - a0) * (b1 - b0)
    which = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    return a0[which] + at // wide[which], b0[which] + at % wide[which]


def link_leaves(values: np.ndarray, group: np.ndarray, budget: int) -> np.ndarray:
    """Component label of each leaf; ``values`` (uint64) ascend within each run of equal ``group``."""
    n = len(values)
    label = np.arange(n)

    def close(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.bitwise_count(values[i] ^ values[j]) <= budget

    if n < 2:
        return label
    # neighbours in the order of the trie first: crowds become one component at once
    near = np.flatnonzero(group[1:] == group[:-1])
    near = near[close(near, near + 1)]
    label = _unite(label, near, near + 1)
    runs = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
    first, last = edge[:-1], edge[1:]
    several = last - first > 1
    first, last = first[several], last[several]
    stack = [(0, first, last, first, last, np.zeros(len(first), np.int8))]
    ones: dict[int, np.ndarray] = {}
    while stack:
        level, a0, a1, b0, b1, differ = stack.pop()
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            stack += [(level, *(x[half:] for x in (a0, a1, b0, b1, differ))), (level, *(x[:half] for x in (a0, a1, b0, b1, differ)))]
            continue
        single = (runs[a0] == runs[a1 - 1]) & (runs[b0] == runs[b1 - 1]) & (label[a0] == label[b0])
        a0, a1, b0, b1, differ = (x[~single] for x in (a0, a1, b0, b1, differ))
        few = ((a1 - a0) * (b1 - b0) <= FEW_PAIRS) | (level == 64)
        at, linked = np.flatnonzero(few), False
        held = np.cumsum((a1[at] - a0[at]) * (b1[at] - b0[at])) // LEAF_PAIRS
        for part in np.split(at, np.flatnonzero(np.diff(held)) + 1) if len(at) else []:
            i, j = _leaf_pairs(a0[part], a1[part], b0[part], b1[part])
            new = label[i] != label[j]
            i, j = i[new], j[new]
            new = close(i, j)
            if new.any():
                label, linked = _unite(label, i[new], j[new]), True
        if linked:
            runs = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
        a0, a1, b0, b1, differ = (x[~few] for x in (a0, a1, b0, b1, differ))
        if not len(a0):
            continue
        if level not in ones:
            bit = (values >> np.uint64(63 - level)) & np.uint64(1)
            ones[level] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        c = ones[level]
        am, bm = a1 - (c[a1] - c[a0]), b1 - (c[b1] - c[b0])
        own = a0 == b0
        other = ~own
        parts = [
            (a0, am, b0, bm, differ),
            (am, a1, bm, b1, differ),
            (a0, am, bm, b1, differ + 1),
            tuple(x[other] for x in (am, a1, b0, bm, differ + 1)),
        ]
        a0, a1, b0, b1, differ = (np.concatenate(x) for x in zip(*parts, strict=True))
        live = (a1 > a0) & (b1 > b0) & (differ <= budget) & ~((a0 == b0) & (a1 - a0 == 1))
        stack.append((level + 1, *(x[live] for x in (a0, a1, b0, b1, differ))))
    return label


def _trie_join(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    table = pa.Table.from_batches(tables)
    trie, leaf = table.column("trie").to_numpy(), table.column("leaf").to_numpy()
    value = table.column("print").to_numpy().view(np.uint64)
    shift = table.column("shift").to_numpy().astype(np.uint64)
    turned = (value << shift) | np.where(shift > 0, value >> ((np.uint64(64) - shift) % np.uint64(64)), np.uint64(0))
    order = np.lexsort((turned, trie))
    trie, turned, leaf = trie[order], turned[order], leaf[order]
    label = link_leaves(turned, trie, budget)
    linked = np.flatnonzero(label != np.arange(len(label)))
    yield pa.RecordBatch.from_arrays([pa.array(leaf[linked]), pa.array(leaf[label[linked]])], ["u", "v"])


def close_links(leaves: DataFrame, budget: int = BUDGET, tile_leaves: int = TILE_LEAVES) -> DataFrame:
    """(u, v): links whose closure is that of all linked pairs of ``leaves``, a written table of (leaf, print)."""
    cut = blocks(budget)
    keys = [
        F.struct(
            (F.lit(i).cast("long") * (1 << 56) + F.shiftrightunsigned(F.shiftleft("print", first), 64 - bits)).alias("trie"),
            F.lit(first).cast("long").alias("shift"),
        )
        for i, (first, bits) in enumerate(cut)
    ]
    rows = leaves.select("leaf", "print", F.explode(F.array(*keys)).alias("k")).select("leaf", "print", "k.trie", "k.shift")
    average = leaves.count() * len(cut) / sum(1 << bits for _, bits in cut)
    most = max(tile_leaves, int(TILE_AVERAGES * average))
    large = materialize(rows.groupBy("trie").agg(F.count("*").alias("n")).where(F.col("n") > most), "large-tries")
    if large.limit(1).count():
        # tile numbers take 16 bits each, below the block number and beside the key
        tiles = large.select("trie", F.least(F.ceil(F.col("n") / most), F.lit(1 << 15)).alias("tiles"))
        rows = rows.join(broadcast_if_small(tiles, 16), "trie", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
        own = F.pmod(F.xxhash64("leaf"), "tiles")
        rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        pair = F.least("own", "other") * (1 << 40) + F.greatest("own", "other") * (1 << 24)
        rows = rows.select("leaf", "print", (F.col("trie") + pair).alias("trie"), "shift")
    return rows.repartition("trie").mapInArrow(lambda b: _trie_join(b, budget), "u long, v long")


# --- components ------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that can be reached, for every node of a link.

    A round gives each node the smallest root among its neighbours and jumps to that root's root.
    """
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    both = materialize(both, "links")
    roots = materialize(both.groupBy(F.col("u").alias("node")).agg(F.least("u", F.min("v")).alias("root")), "roots")
    while True:
        seen = both.join(roots.select(F.col("node").alias("v"), "root"), "v").groupBy(F.col("u").alias("node")).agg(F.min("root").alias("near"))
        moved = roots.join(seen, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        moved = materialize(moved, "roots-moved")
        above = moved.select(F.col("node").alias("root"), F.col("root").alias("top"))
        jumped = materialize(moved.join(above, "root").select("node", "old", F.least("root", "top").alias("root")), "roots")
        roots = jumped.select("node", "root")
        if not jumped.where("root <> old").limit(1).count():
            return roots


def near_copies(docs: DataFrame, id_column: str = "doc_id", size: int = SHINGLE_WORDS, budget: int = BUDGET) -> DataFrame:
    """(id, print, component) for each row; ``component`` is the smallest id of all rows that links reach."""
    rows = materialize(fingerprints(docs, id_column, size), "fingerprints")
    leaves = rows.groupBy("print").agg(F.min("id").alias("first")).withColumn("leaf", F.monotonically_increasing_id())
    leaves = materialize(leaves, "leaves")
    links = materialize(close_links(leaves.select("leaf", "print"), budget), "links-found")
    roots = components(links)
    known = leaves.join(roots.withColumnRenamed("node", "leaf"), "leaf", "left").withColumn("root", F.coalesce("root", "leaf"))
    named = known.groupBy("root").agg(F.min("first").alias("component"))
    named = materialize(known.select("print", "root").join(named, "root").select("print", "component"), "components")
    # equal texts are one row there, however many rows they have here
    return rows.join(broadcast_if_small(named, 24), "print").select("id", "print", "component")

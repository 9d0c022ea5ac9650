"""Product codes of vectors: a codebook for each part, trained in whole numbers, and searched through a tree.

Components are multiplied by ``SCALE`` and rounded down. Vectors are cut into ``PARTS`` consecutive parts, and each part has a codebook of
``ENTRIES`` vectors, first those of the lowest ids. A round gives each part to the nearest entry (lower number
on ties) and moves each entry to the mean of its parts, rounded down; an entry without parts stays.

The nearest entry is found in a geometric near-neighbour access tree over the entries: a node has a few split points far from each other, each other
entry belongs to its nearest split point, and the node keeps, for each split point and each group, the lowest and the highest distance
between them. The distance of a query to one split point rules out every group whose range lies, by the triangle inequality,
farther than the best entry so far. Ranges and bounds are rounded outwards and a group goes only if it is strictly farther, so no
entry at the least distance is lost; which entry is nearest is decided on squared distances in whole numbers.

Codebooks have ``ENTRIES`` times the dimension numbers, whatever the table, and go to the tasks with the code; a task returns one
sum for each number. Numbers too large for 64 bits are computed as Python integers.

Defined cases: rows whose vector is missing, has no components, or holds a missing or non-finite one go. Of several vectors with one id the
smallest begins a codebook, and missing ids come last; every row is coded. With fewer ids than entries, codebooks are smaller. Vectors of
different lengths, or of a length that parts do not divide, fail the job, as does a number of 2^62 or more. An error beyond 64 bits is given as
the largest long. No rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semprune.functions.arrow import list_matrix
from semprune.llm.common import broadcast_if_small
from semprune.session import materialize

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Split points of a node; so few entries are a node without split points below.
DEGREE = 4
#: Vectors a task searches for at once.
BLOCK = 8192
LARGEST = 1 << 62
#: Relative error that covers conversion, square root and difference of doubles many times over.
SLACK = 2.0**-48
LONG_MAX = (1 << 63) - 1


# --- tree of entries -------------------------------------------------------------------------


@dataclass
class Node:
    """Split points (numbers of entries), ranges of distances [split point, group], and the rest of each group."""

    splits: list[int]
    low: np.ndarray
    high: np.ndarray
    rest: list[Node | None]


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    gap = x - y
    return (gap * gap).sum(axis=1) if gap.shape[1] else np.zeros(len(gap), x.dtype)


def _roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def build_tree(entries: np.ndarray, numbers: list[int] | None = None, degree: int = DEGREE) -> Node | None:
    """The tree over the given entries; split points are taken far from those before."""
    numbers = list(range(len(entries))) if numbers is None else numbers
    if not numbers:
        return None
    points = entries[numbers]
    splits = [0]
    away = _squares(points, points[0])
    while len(splits) < min(degree, len(numbers)):
        away[splits] = -1
        splits.append(max(range(len(numbers)), key=lambda i: (away[i], -i)))
        away = np.minimum(away, _squares(points, points[splits[-1]]))
    distances = np.stack([_roots(_squares(points, points[s])) for s in splits])
    home = distances.argmin(axis=0)
    home[splits] = np.arange(len(splits))
    low, high = np.full((len(splits),) * 2, np.inf), np.full((len(splits),) * 2, -np.inf)
    rest: list[Node | None] = []
    for group in range(len(splits)):
        below = [i for i in np.flatnonzero(home == group).tolist() if i not in splits]
        for s in range(len(splits)):
            # the distance of a split point to itself says nothing about the rest of its group
            seen = distances[s, below if s == group else [splits[group], *below]]
            if len(seen):
                low[s, group], high[s, group] = seen.min() * (1 - SLACK), seen.max() * (1 + SLACK)
        rest.append(build_tree(entries, [numbers[i] for i in below], degree))
    return Node([numbers[s] for s in splits], low, high, rest)


def nearest(queries: np.ndarray, entries: np.ndarray, tree: Node | None, met: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest entry of each query; ``met`` gets the number of distances computed."""
    n = len(queries)
    best = np.full(n, -1, queries.dtype)  # of nothing yet
    number = np.zeros(n, np.int64)
    radius = np.full(n, np.inf)
    if tree is None:
        return number, best
    todo = [(tree, np.arange(n))]
    while todo:
        node, rows = todo.pop()
        open_ = np.ones((len(node.splits), len(rows)), bool)  # groups that may hold something nearer or as near
        for s, entry in enumerate(node.splits):
            here = open_[s].copy()
            at = rows[here]
            if not len(at):
                continue
            squares = _squares(queries[at], entries[entry])
            if met is not None:
                met.append(len(at))
            better = (best[at] < 0) | (squares < best[at]) | ((squares == best[at]) & (entry < number[at]))
            best[at[better]], number[at[better]] = squares[better], entry
            distance = _roots(squares)
            radius[at] = _roots(best[at]) * (1 + SLACK)
            for group in range(len(node.splits)):
                gap = np.maximum(distance * (1 - SLACK) - node.high[s, group], node.low[s, group] - distance * (1 + SLACK))
                # a rest without entries has an endless gap and goes
                open_[group, here] &= ~(gap * (1 - SLACK) > radius[at])
        todo += [(child, rows[open_[g]]) for g, child in enumerate(node.rest) if child is not None and open_[g].any()]
    return number, best


# --- whole numbers ---------------------------------------------------------------------------


def whole_numbers(column: pa.Array, parts: int, dim: int | None = None) -> np.ndarray:
    """Rows of ``floor(SCALE * x)`` cut into parts, [row, part, place]; as Python integers where squares could pass 64 bits."""
    x = np.floor(list_matrix(column, dim) * SCALE)
    if x.shape[1] % parts:
        raise ValueError(f"{x.shape[1]} components cannot be cut into {parts} equal parts")
    largest = float(np.abs(x).max()) if x.size else 0.0
    if largest >= LARGEST:
        raise ValueError("a component is too large")
    width = x.shape[1] // parts
    x = x.astype(np.int64)
    if width * (2 * largest + 2) ** 2 >= LARGEST:
        x = x.astype(object)
    return x.reshape(len(x), parts, width)


@dataclass
class Codebooks:
    """Entries [part, number, place] and the tree of each part."""

    entries: np.ndarray
    trees: list[Node | None]

    @staticmethod
    def of(entries: np.ndarray) -> Codebooks:
        return Codebooks(entries, [build_tree(part) for part in entries])

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.entries.ravel()).encode()).hexdigest()

    def code(self, x: np.ndarray, met: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and squared distances, [row, part]."""
        entries = self.entries
        if x.dtype == object or entries.dtype == object:
            x, entries = x.astype(object), entries.astype(object)
        found = [nearest(x[:, p], entries[p], self.trees[p], met) for p in range(len(entries))]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


def _sums(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    """One row for each number of the codebooks that the task has parts for."""
    parts, entries, width = books.entries.shape
    counts, totals = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), object)
    for batch in _blocks(batches):
        x = whole_numbers(batch.column("embedding"), parts, parts * width)
        codes, _ = books.code(x)
        for p in range(parts):
            sums = np.zeros((entries, width), x.dtype)
            np.add.at(sums, codes[:, p], x[:, p])
            totals[p] += sums
            counts[p] += np.bincount(codes[:, p], minlength=entries)
    used = np.argwhere(np.repeat(counts[:, :, None] > 0, width, axis=2))
    p, e, i = used.T
    columns = [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(i, pa.int32()), pa.array(counts[p, e])]
    columns.append(pa.array([Decimal(v) for v in totals[p, e, i]], pa.decimal128(38, 0)))
    yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "place", "n", "total"])


def _codes(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    parts, _, width = books.entries.shape
    for batch in _blocks(batches):
        codes, squares = books.code(whole_numbers(batch.column("embedding"), parts, parts * width))
        errors = [min(sum(map(int, row)), LONG_MAX) for row in squares]
        names = [bytes(row).hex() for row in codes.astype(np.uint8)]
        columns = [batch.column("vec_id"), batch.column("label"), pa.array(names, pa.string()), pa.array(errors, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])


# --- training --------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The vectors of the lowest ids, of each id the smallest."""
    ids = [r.vec_id for r in rows.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()]
    if not ids:
        return None
    chosen = F.col("vec_id").isin([i for i in ids if i is not None]) | (F.col("vec_id").isNull() & F.lit(None in ids))
    table = rows.where(chosen).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).orderBy(F.col("vec_id").asc_nulls_last()).toArrow()
    return Codebooks.of(np.moveaxis(whole_numbers(table.column("embedding").combine_chunks(), parts), 0, 1))


def refined(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: assign all parts, move every entry that has parts to their mean, rounded down."""
    sums = rows.select("embedding").mapInArrow(lambda b: _sums(b, books), "part int, entry int, place int, n long, total decimal(38,0)")
    new = books.entries.copy()
    # as many rows as the codebooks have numbers
    for r in sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        new[r.part, r.entry, r.place] = int(r.total) // r.n
    return Codebooks.of(new)


def fit_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks trained on all written ``rows(vec_id, embedding)``; none without rows."""
    books = first_codebooks(rows, parts, entries)
    for _ in range(rounds if books else 0):
        books = refined(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error); ``code`` has two hexadecimal digits for each part."""
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}, code string, error long"
    return rows.mapInArrow(lambda b: _codes(b, books), schema)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for each row of ``vectors(vec_id, embedding, label)`` with a vector."""
    kept = vectors.select("vec_id", "embedding", "label").where(usable(F.col("embedding")))
    kept = materialize(kept, "vectors-kept")
    books = fit_codebooks(kept, parts, entries, rounds)
    if books is None:
        empty = kept.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
        return empty.withColumn("codebooks_sha256", F.lit("")).limit(0)
    coded = materialize(encode(kept, books), "codes")
    largest = F.lit(LONG_MAX).cast("decimal(38,0)")
    total = F.least(F.sum(F.col("error").cast("decimal(19,0)")).cast("decimal(38,0)"), largest).cast("long")
    labels = materialize(coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")), "label-errors")
    both = coded.join(broadcast_if_small(labels, 32), F.col("label").eqNullSafe(F.col("of")))
    return both.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))

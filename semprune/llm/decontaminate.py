"""Benchmark decontamination: items found in documents up to a budget of edits.

An item of L characters may differ in k = L // 20 edits; one of fewer than ``SHORT_CHARS`` must stand there unchanged, between the ends of words,
as a few letters within an edit of each other are no evidence. It is split into k + 1 pieces; if a passage is
within k edits of it, one piece at least is there unchanged (pigeonhole). All pieces of a block of items
form one automaton, each document is run through it where it is scanned, and around every hit
Myers' bit-parallel algorithm takes the smallest edit distance of the item to any part of the text.
Nothing is shuffled. Items are taken in blocks of bounded bytes, a pass over the documents each, so
a large benchmark does not have to fit anywhere as a whole.

Both sides are compared in lower case with white space runs as one space. Defined cases: a missing text
is empty; an item without a word says nothing and is found nowhere; repeated rows and items
count each; texts are read whole; columns of any name are kept where documents are returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHARS_PER_EDIT = 20
SHORT_CHARS = 32
BLOCK_BYTES = 8 << 20

HITS = "doc_id long, item_id long, distance int, end long"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget_of(item: str) -> int:
    return len(item) // CHARS_PER_EDIT if len(item) >= SHORT_CHARS else 0


def stands_alone(item: str, line: str, at: int) -> bool:
    """Whether no word of ``line`` goes on across an end of the item found at ``at``."""
    joined = lambda a, b: a.isalnum() and b.isalnum()
    return not joined(line[at - 1 : at], item[:1]) and not joined(item[-1:], line[at + len(item) : at + len(item) + 1])


def pieces_of(item: str) -> list[tuple[int, str]]:
    """(offset, piece): budget + 1 pieces of nearly equal length."""
    n = budget_of(item) + 1
    edges = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """(distance, end): the smallest edit distance of the pattern to any part of the text, and where that ends first."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    plus, minus, score = full, 0, m
    best, end = m, 0
    for at, c in enumerate(text):
        eq = masks.get(c, 0)
        zero = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (full & ~(zero | plus))
        down = plus & zero
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(zero | up)), up & zero
        if score < best:
            best, end = score, at + 1
    return best, end


class Finder:
    """Items of one block: (item_id, text)."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        import ahocorasick

        self.items = [(i, normal(t)) for i, t in items]
        self.items = [(i, t) for i, t in self.items if t]
        self.pieces = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text) in enumerate(self.items):
            for offset, piece in pieces_of(text):
                places.setdefault(piece, []).append((number, offset + len(piece)))
        for piece, where in places.items():
            self.pieces.add_word(piece, where)
        if self.items:
            self.pieces.make_automaton()

    def hits(self, text: str | None, first: bool = False) -> list[tuple[int | None, int, int]]:
        """(item_id, distance, end) for each item within its budget; with ``first``, one is enough."""
        if not self.items:
            return []
        line = normal(text)
        starts: dict[int, set[int]] = {}
        for end, where in self.pieces.iter(line):
            for number, behind in where:
                starts.setdefault(number, set()).add(end + 1 - behind)
        found = []
        for number, begins in starts.items():
            item_id, item = self.items[number]
            budget, best = budget_of(item), None
            if len(item) < SHORT_CHARS:
                alone = [at for at in begins if stands_alone(item, line, at)]
                best, begins = (item_id, 0, min(alone) + len(item)) if alone else None, set()
            for low, high in _merged(sorted(begins), 2 * budget + len(item)) if begins else ():
                low, high = max(0, low - budget), high + len(item) + budget
                at = line.find(item, low, high)
                distance, end = (0, at + len(item)) if at >= 0 else myers(item, line[low:high])
                end += 0 if at >= 0 else low
                if distance <= budget and (best is None or distance < best[1]):
                    best = (item_id, distance, end)
                if distance == 0:
                    break
            if best:
                found.append(best)
                if first:
                    break
        return found


def _merged(begins: list[int], gap: int) -> Iterator[tuple[int, int]]:
    """Places at most ``gap`` apart, as ranges."""
    low = high = begins[0]
    for b in begins[1:]:
        if b - high > gap:
            yield low, high
            low = b
        high = b
    yield low, high


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """(item_id, text) of one block of items after another, each of about ``block_bytes``."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = math.ceil(size / block_bytes)
    for k in range(n):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [tuple(row) for row in block.collect()]


def _held(items) -> Finder:
    """The finder of a broadcast block, built once in a worker."""
    if _held.of is not items:
        _held.of, _held.finder = items, Finder(items)
    return _held.finder


_held.of = _held.finder = None


def _find(batches: Iterator[pa.RecordBatch], items) -> Iterator[pa.RecordBatch]:
    finder = _held(items.value)
    for batch in batches:
        rows = [(i, *hit) for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for hit in finder.hits(t.as_py())]
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "item_id", "distance", "end"])


def _drop(batches: Iterator[pa.RecordBatch], items, at: int) -> Iterator[pa.RecordBatch]:
    finder = _held(items.value)
    for batch in batches:
        yield batch.filter(pa.array([not finder.hits(t.as_py(), True) for t in batch.column(at)], pa.bool_()))


def find_items(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, distance, end) of every item found in a document; ``end`` counts characters of the normal text."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = spark.createDataFrame([], HITS)
    for block in item_blocks(benchmark, block_bytes):
        items = spark.sparkContext.broadcast(block)
        found = found.unionByName(rows.mapInArrow(lambda b, items=items: _find(b, items), HITS))
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the documents in which an item is found."""
    spark, names = docs.sparkSession, docs.columns
    at = names.index("text")
    docs = docs.toDF(*[f"c{i}" for i in range(len(names))])
    for block in item_blocks(benchmark, block_bytes):
        items = spark.sparkContext.broadcast(block)
        docs = docs.mapInArrow(lambda b, items=items: _drop(b, items, at), docs.schema)
    return docs.toDF(*names)

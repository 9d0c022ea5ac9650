"""Bounded-space online packing of token sequences.

Each partition keeps a fixed number of open windows. What a document has beyond full windows goes to
the open window it fits best; if none has room, the fullest is emitted and a new one opened. Windows
that are open when a partition ends are left over: those of a few partitions at a time are merged,
laid end to end and cut at the window size, so that one sequence of a group is padded at most.
Documents are tokenized where they are scanned; only left-over windows, a bounded number for each
partition, are moved. The pieces are written once, which fixes sequence numbers whatever executors
are lost later.

Defined cases: a missing text is empty and has the end id alone; repeated rows are packed each; long
texts become full windows and a remainder; an empty table has no pieces; other columns are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semprune.llm.tokens import encoder
from semprune.session import scratch_path

WINDOW = 2048
OPEN_WINDOWS = 64
END_ID = 1
MERGED_PARTITIONS = 8
#: Merged sequences are numbered from here, others by partition.
MERGED_FROM = 1 << 62

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, left_over boolean"
ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("left_over", pa.bool_()),
])
BATCH_BYTES = 4 << 20


class _Rows:
    """Output rows, handed on in batches of bounded size."""

    def __init__(self):
        self.rows, self.bytes = [], 0

    def add(self, pieces: list[tuple], sequence: int, left_over: bool) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, ids, total, sequence, offset, left_over))
            offset += n
            self.bytes += len(ids) + 64

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(ARROW)
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW)
        self.rows, self.bytes = [], 0
        return out


class Packer:
    """Open windows of one partition; a piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, window: int, open_windows: int, emit):
        self.window, self.limit, self.emit = window, open_windows, emit
        self.free: list[tuple[int, int]] = []  # (free places, number), ascending
        self.pieces: dict[int, list[tuple]] = {}
        self.opened = 0

    def add(self, piece: tuple) -> None:
        size = len(piece[2]) // 4
        at = bisect.bisect_left(self.free, (size, -1))
        if at < len(self.free):
            room, number = self.free.pop(at)
        else:
            if len(self.free) == self.limit:
                _, fullest = self.free.pop(0)
                self.emit(self.pieces.pop(fullest), False)
            room, number = self.window, self.opened
            self.opened += 1
            self.pieces[number] = []
        self.pieces[number].append(piece)
        if room == size:
            self.emit(self.pieces.pop(number), False)
        else:
            bisect.insort(self.free, (room - size, number))

    def close(self) -> None:
        for _, number in self.free:
            self.emit(self.pieces.pop(number), True)


def cut_to_windows(pieces: Iterator[tuple], window: int) -> Iterator[list[tuple]]:
    """Pieces laid end to end and cut at the window size."""
    current, used = [], 0
    for doc_id, start, ids, total in pieces:
        while ids:
            taken = ids[: 4 * (window - used)]
            current.append((doc_id, start, taken, total))
            used += len(taken) // 4
            start += len(taken) // 4
            ids = ids[len(taken) :]
            if used == window:
                yield current
                current, used = [], 0
    if current:
        yield current


def _pack_partition(batches: Iterator[pa.RecordBatch], window: int, open_windows: int, paths: tuple) -> Iterator[pa.RecordBatch]:
    out, encode = _Rows(), encoder(*paths).encode
    sequence = TaskContext.get().partitionId() << 32
    end = END_ID.to_bytes(4, "little")

    def emit(pieces: list[tuple], left_over: bool) -> None:
        nonlocal sequence
        out.add(pieces, sequence, left_over)
        sequence += 1

    packer = Packer(window, open_windows, emit)
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = encode(text.as_py() or "") + end
            total = len(ids) // 4
            whole = total // window * window
            for start in range(0, whole, window):
                emit([(doc_id, start, ids[4 * start : 4 * (start + window)], total)], False)
            if whole < total:
                packer.add((doc_id, whole, ids[4 * whole :], total))
            if out.bytes >= BATCH_BYTES:
                yield out.batch()
    packer.close()
    yield out.batch()


def _merge_group(key: tuple, left: pa.Table, window: int) -> pa.Table:
    out, sequence = _Rows(), MERGED_FROM + (key[0].as_py() << 32)
    left = left.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
    pieces = zip(*[left.column(n).to_pylist() for n in ("doc_id", "start", "ids", "doc_tokens")], strict=True)
    for sequence_pieces in cut_to_windows(pieces, window):
        out.add(sequence_pieces, sequence, False)
        sequence += 1
    return pa.Table.from_batches([out.batch()])


def pack_documents(
    docs: DataFrame, window: int = WINDOW, open_windows: int = OPEN_WINDOWS, json_path: str | None = None, ranks_path: str | None = None
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): the pieces of all documents.

    ``ids`` are little-endian unsigned 32-bit numbers; the ids of a document end with ``END_ID``.
    """
    paths = (json_path, ranks_path)
    placed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lambda b: _pack_partition(b, window, open_windows, paths), SCHEMA)
    path = scratch_path(docs.sparkSession, "packed")
    placed.write.option("compression", "zstd").parquet(path)
    written = docs.sparkSession.read.schema(SCHEMA).parquet(path)
    group = F.shiftright("sequence_id", 32) / MERGED_PARTITIONS
    left = written.where("left_over").withColumn("group", group.cast("long"))
    merged = left.groupBy("group").applyInArrow(lambda key, rows: _merge_group(key, rows, window), SCHEMA)
    return written.where("NOT left_over").unionByName(merged).drop("left_over")


def padding(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row: sequences, tokens and padded places, a sequence of a power of two tokens having none."""
    used = pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    even = F.bit_count("used") == 1
    return used.agg(F.count("*").alias("sequences"), F.sum("used").alias("tokens"), F.sum(F.when(even, 0).otherwise(window - F.col("used"))).alias("padded"))

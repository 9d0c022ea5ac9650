"""Nearest centroid by inner product, exact over all centroids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semprune.functions.arrow import list_matrix
from semprune.operators.positions import position_by_order
from semprune.session import materialize

# Largest centroid matrix (float64 bytes) sent to every executor; larger ones are sent in blocks.
BROADCAST_LIMIT = 1 << 28
# Work block inside a task: vectors x centroids scored by one matrix product.
ROW_BLOCK = 1024
CENTROID_BLOCK = 8192


def centroid_shape(centroids: DataFrame) -> tuple[int, int]:
    """(k, d) after checking that ids are distinct and all centroids have d components."""
    row = centroids.agg(
        F.count("*").alias("k"),
        F.count_distinct("cid").alias("ids"),
        F.min(F.size("centroid")).alias("low"),
        F.max(F.size("centroid")).alias("high"),
    ).first()
    if not row.k:
        raise ValueError("no centroids")
    if row.ids != row.k or row.low != row.high:
        raise ValueError("centroids need distinct ids and one dimension")
    return row.k, row.high


def best_match(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row-wise best inner product and its first position, in bounded memory."""
    best = np.full(len(x), -np.inf)
    where = np.zeros(len(x), dtype=np.int64)
    for r in range(0, len(x), ROW_BLOCK):
        rows = x[r : r + ROW_BLOCK]
        if np.isnan(rows).any():
            raise ValueError("a vector has a component that is no number")
        for c in range(0, len(centroids), CENTROID_BLOCK):
            sims = rows @ centroids[c : c + CENTROID_BLOCK].T
            arg = sims.argmax(axis=1)
            top = sims[np.arange(len(rows)), arg]
            better = top > best[r : r + ROW_BLOCK]
            best[r : r + ROW_BLOCK][better] = top[better]
            where[r : r + ROW_BLOCK][better] = arg[better] + c
    return best, where


def result_schema(vectors: DataFrame, keep: list[str]) -> T.StructType:
    fields = [T.StructField(name, vectors.schema[name].dataType) for name in keep]
    return T.StructType([*fields, T.StructField("cid", T.IntegerType()), T.StructField("centroid_sim", T.DoubleType())])


def share_centroids(centroids: DataFrame, dim: int) -> Broadcast:
    """(ids, matrix) on every executor, in order of ``cid``; the caller has checked the size."""
    table = centroids.select("cid", "centroid").toArrow().sort_by("cid")
    matrix = list_matrix(table.column("centroid"), dim)
    return centroids.sparkSession.sparkContext.broadcast((table.column("cid").to_numpy(), matrix))


def _assign_broadcast(vectors: DataFrame, centroids: DataFrame, keep: list[str], dim: int) -> DataFrame:
    shared = share_centroids(centroids, dim)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = shared.value
        for batch in batches:
            best, where = best_match(list_matrix(batch.column("embedding"), dim), matrix)
            columns = [batch.column(name) for name in keep]
            columns += [pa.array(ids[where], pa.int32()), pa.array(best, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "cid", "centroid_sim"])

    return vectors.select(*keep, *([] if "embedding" in keep else ["embedding"])).mapInArrow(score, result_schema(vectors, keep))


def _assign_passes(vectors: DataFrame, centroids: DataFrame, keep: list[str], k: int, dim: int, limit: int) -> DataFrame:
    """One pass for each block of centroids, in order of ``cid``, with the best so far as two columns.

    Vectors stay where they are and need no key. Every pass but the last is written, so no
    executor holds more than one block.
    """
    per_block = max(1, limit // (8 * dim))
    numbered = materialize(position_by_order(centroids.select("cid", "centroid"), [], [F.col("cid")], "place"), "centroids")
    carried = keep if "embedding" in keep else [*keep, "embedding"]
    schema = result_schema(vectors, carried)

    def one_pass(rows: DataFrame, shared: Broadcast) -> DataFrame:
        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, matrix = shared.value
            for batch in batches:
                best, where = best_match(list_matrix(batch.column("embedding"), dim), matrix)
                cid, sim = ids[where], best
                if "cid" in batch.schema.names:
                    before = batch.column("centroid_sim").to_numpy()
                    stays = before >= best
                    cid = np.where(stays, batch.column("cid").to_numpy(), cid)
                    sim = np.where(stays, before, best)
                columns = [batch.column(name) for name in carried]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(cid, pa.int32()), pa.array(sim, pa.float64())], names=schema.names)

        return rows.mapInArrow(score, schema)

    rows = vectors.select(*carried)
    for low in range(0, k, per_block):
        block = numbered.where(F.col("place").between(low, low + per_block - 1))
        shared = share_centroids(block, dim)
        rows = one_pass(rows, shared)
        if low + per_block < k:
            rows = materialize(rows, "assigned-so-far")
            shared.destroy()
    return rows.select(*keep, "cid", "centroid_sim")


def assign_nearest(
    vectors: DataFrame,
    centroids: DataFrame,
    keep: list[str] | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Nearest centroid of every vector: the highest inner product, lowest ``cid`` on ties.

    ``vectors(keep…, embedding)``, ``centroids(cid, centroid)`` -> ``keep…, cid, centroid_sim``, a
    row for each row whatever ``keep`` holds. Centroids are broadcast, at once when the matrix is
    within ``broadcast_limit`` bytes, or else block by block; the vectors stay where they are.
    A component that is no number fails the job.
    """
    results = ("cid", "centroid_sim")
    keep = keep or [c for c in vectors.columns if c not in ("embedding", *results)]
    if any(c in results for c in keep):
        raise ValueError(f"columns {results} are results and cannot be kept")
    k, dim = centroid_shape(centroids)
    if 8 * k * dim <= broadcast_limit:
        return _assign_broadcast(vectors, centroids, keep, dim)
    return _assign_passes(vectors, centroids, keep, k, dim, broadcast_limit)

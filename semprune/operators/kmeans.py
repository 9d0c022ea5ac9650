"""Spherical k-means over DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from semprune.functions.arrow import list_matrix, matrix_list
from semprune.functions.text import sample_hash
from semprune.functions.vectors import l2_normalize
from semprune.operators.assign import BROADCAST_LIMIT, assign_nearest, best_match, centroid_shape, share_centroids
from semprune.operators.quantiles import values_at
from semprune.session import materialize

SEED = 1234
MAX_POINTS_PER_CENTROID = 256
# Relative shift of the components of a centroid that replaces an empty one.
SPLIT_SHIFT = 1 / 1024


def lowest_hashes(rows: DataFrame, n: int, seed: int, key: str = "idx") -> DataFrame:
    """The ``n`` rows with the lowest seeded hash of ``key``: a repeatable random draw.

    The n-th lowest hash is found by counting, so the draw is a filter on the scan and no
    rows are sorted or gathered. All rows when there are at most ``n``.
    """
    hashed = rows.select(sample_hash(F.col(key), seed).alias("h"))
    ranks = F.array(F.struct(F.lit(0).alias("label"), F.lit(n - 1).cast("long").alias("rank")))
    found = values_at(hashed, "h", ranks).first()
    return rows if found is None else rows.where(sample_hash(F.col(key), seed) <= F.lit(found.value))


def train_subsample(
    vectors: DataFrame, k: int, max_points_per_centroid: int = MAX_POINTS_PER_CENTROID, seed: int = SEED
) -> DataFrame:
    """A sample of at most ``k * max_points_per_centroid`` rows, for those who ask for one: nothing here calls it."""
    return lowest_hashes(vectors, k * max_points_per_centroid, seed)


def initial_centroids(sample: DataFrame, k: int, seed: int) -> DataFrame:
    """``k`` training rows as the first centroids, numbered in hash order."""
    drawn = lowest_hashes(sample, k, seed + 1)
    # k rows of two numbers each.
    numbered = drawn.select("idx", (F.row_number().over(Window.orderBy(sample_hash(F.col("idx"), seed + 1), "idx")) - 1).alias("cid"))
    return numbered.join(sample, "idx").select("cid", l2_normalize(F.col("embedding")).alias("centroid"))


def cluster_means(members: DataFrame) -> DataFrame:
    """(cid, embedding) -> (cid, n, centroid): unit-length mean, summed before the shuffle."""
    mean = Summarizer.mean(array_to_vector("embedding"))
    means = members.groupBy("cid").agg(F.count("*").alias("n"), vector_to_array(mean).alias("mean"))
    return means.select("cid", "n", l2_normalize(F.col("mean")).alias("centroid"))


PARTIAL_SCHEMA = "cid int, n long, total array<double>"


# Bytes of sums a task holds before it hands them on.
SUM_BYTES = 64 << 20


class _Sums:
    """Numbers and vector sums of the clusters a task has met."""

    def __init__(self, dim: int):
        self.dim, self.places = dim, {}
        self.counts, self.totals = np.zeros(0, np.int64), np.zeros((0, dim))

    def add(self, cids: np.ndarray, matrix: np.ndarray) -> None:
        found, inverse = np.unique(cids, return_inverse=True)
        places = np.array([self.places.setdefault(int(c), len(self.places)) for c in found])
        grown = len(self.places) - len(self.counts)
        if grown > 0:
            self.counts = np.r_[self.counts, np.zeros(max(grown, len(self.counts)), np.int64)]
            self.totals = np.r_[self.totals, np.zeros((len(self.counts) - len(self.totals), self.dim))]
        order = np.argsort(inverse, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(inverse[order]) != 0])
        self.totals[places] += np.add.reduceat(matrix[order], first, axis=0)
        self.counts[places] += np.diff(np.r_[first, len(cids)])

    def full(self) -> bool:
        return self.totals.nbytes > SUM_BYTES

    def batch(self) -> pa.RecordBatch:
        n = len(self.places)
        columns = [pa.array(list(self.places), pa.int32()), pa.array(self.counts[:n]), matrix_list(self.totals[:n], pa.float64())]
        self.__init__(self.dim)
        return pa.RecordBatch.from_arrays(columns, names=["cid", "n", "total"])


def _summed(batches: Iterator[pa.RecordBatch], dim: int, cids_of) -> Iterator[pa.RecordBatch]:
    """Sums of a task, handed on at its end or when they exceed ``SUM_BYTES``."""
    sums = _Sums(dim)
    for batch in batches:
        if batch.num_rows:
            x = list_matrix(batch.column("embedding"), dim)
            sums.add(cids_of(batch, x), x)
            if sums.full():
                yield sums.batch()
    if sums.places:
        yield sums.batch()


def _nearest_sums(sample: DataFrame, centroids: DataFrame, dim: int) -> tuple[DataFrame, Broadcast]:
    """Assign and add up in one pass; only the sums leave the task."""
    shared = share_centroids(centroids, dim)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = shared.value
        return _summed(batches, dim, lambda batch, x: ids[best_match(x, matrix)[1]])

    return sample.select("embedding").mapInArrow(add, PARTIAL_SCHEMA), shared


def member_sums(assigned: DataFrame, dim: int) -> DataFrame:
    """Partial sums of rows that carry their cluster."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _summed(batches, dim, lambda batch, x: batch.column("cid").to_numpy())

    return assigned.select("cid", "embedding").mapInArrow(add, PARTIAL_SCHEMA)


def _refill_empty(means: DataFrame, centroids: DataFrame) -> DataFrame:
    """Give every cluster without members a shifted copy of one of the largest clusters.

    The two halves of a split differ by a small shift in opposite directions. Works on one
    row per cluster.
    """
    sizes = centroids.select("cid").join(means.select("cid", "n"), "cid", "left").fillna(0, ["n"])
    empty = sizes.where("n = 0").withColumn("turn", F.row_number().over(Window.orderBy("cid")))
    donors = sizes.where("n > 1").withColumn("turn", F.row_number().over(Window.orderBy(F.desc("n"), "cid")))
    splits = empty.select(F.col("cid").alias("empty_cid"), "turn").join(donors.select("cid", "turn"), "turn", "right")
    shifted = means.join(splits.select("cid", "empty_cid"), "cid", "left")
    copies = F.when(F.col("empty_cid").isNull(), F.array(F.struct(F.col("cid").alias("cid"), F.lit(0).alias("side"))))
    copies = copies.otherwise(
        F.array(
            F.struct(F.col("cid").alias("cid"), F.lit(-1).alias("side")),
            F.struct(F.col("empty_cid").alias("cid"), F.lit(1).alias("side")),
        )
    )
    shifted = shifted.select(F.explode(copies).alias("copy"), "centroid").select("copy.cid", "copy.side", "centroid")
    sign = F.col("side")
    moved = F.transform(F.col("centroid"), lambda x, i: x * (1 + F.when(i % 2 == 0, sign).otherwise(-sign) * SPLIT_SHIFT))
    filled = shifted.select("cid", l2_normalize(moved).alias("centroid"))
    # More empty clusters than donors: the rest keep their centroid.
    return centroids.join(filled.withColumnRenamed("centroid", "new"), "cid", "left").select(
        "cid", F.coalesce("new", "centroid").alias("centroid")
    )


def moved_by_sums(partial: DataFrame, centroids: DataFrame, k: int) -> DataFrame:
    """New centroids from partial sums, written; clusters are refilled only when some are empty."""
    total = vector_to_array(Summarizer.sum(array_to_vector("total")))
    sums = partial.groupBy("cid").agg(F.sum("n").alias("n"), total.alias("total"))
    means = materialize(sums.select("cid", "n", l2_normalize(F.col("total")).alias("centroid")), "means")
    if means.count() == k:
        return means.select("cid", "centroid")
    return materialize(_refill_empty(means, centroids), "centroids")


def _moved(sample: DataFrame, centroids: DataFrame, k: int, dim: int, broadcast_limit: int) -> DataFrame:
    if 8 * k * dim > broadcast_limit:
        assigned = assign_nearest(sample, centroids, ["idx", "embedding"], broadcast_limit)
        return moved_by_sums(member_sums(assigned, dim), centroids, k)
    partial, shared = _nearest_sums(sample, centroids, dim)
    moved = moved_by_sums(partial, centroids, k)
    shared.destroy()
    return moved


def lloyd_step(sample: DataFrame, centroids: DataFrame, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """One iteration: assign the sample to the centroids and move them to the member means."""
    return _moved(sample, centroids, *centroid_shape(centroids), broadcast_limit)


def training_rows(vectors: DataFrame, k: int, seed: int) -> tuple[DataFrame, int, DataFrame]:
    """(rows, number of rows, first centroids), both tables written."""
    sample = materialize(vectors.select("idx", "embedding"), "train")
    n = sample.count()
    if n < k:
        raise ValueError(f"{n} training rows for {k} clusters")
    return sample, n, materialize(initial_centroids(sample, k, seed), "centroids")


def fit_kmeans(
    vectors: DataFrame, k: int, n_iter: int = 40, seed: int = SEED, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """``k`` unit-length centroids (cid, centroid) after ``n_iter`` iterations over all rows.

    ``vectors(idx, embedding)``. The rows are written once; every iteration reads them, and its
    centroids are written so that an iteration never repeats an earlier one. To train on a
    sample, pass one (``train_subsample``).
    """
    sample, _, centroids = training_rows(vectors, k, seed)
    _, dim = centroid_shape(centroids)
    for _ in range(n_iter):
        centroids = _moved(sample, centroids, k, dim, broadcast_limit)
    return centroids.select(F.col("cid").cast("int").alias("cid"), F.col("centroid").cast("array<float>").alias("centroid"))


def objective(assigned: DataFrame) -> DataFrame:
    """Mean similarity to the nearest centroid."""
    return assigned.agg(F.avg("centroid_sim").alias("mean_similarity"))

"""Spherical k-means that carries bounds from one iteration to the next, so that most rows skip most products.

Beside its cluster a row keeps a lower bound of the product with its own centroid and, for each group of
centroids, an upper bound of the products with the others of the group. When centroids move, a product changes by at
most the length of the row times the distance moved; bounds follow without a product. A row whose upper bounds
all lie below its lower bound stays; otherwise its own product is computed, and then only the groups that may still hold
something nearer. Where two products are equal within rounding, all are computed, so that clusters
are those of the plain iteration, which takes the lowest id on ties.

The rows are written with their bounds in every iteration, which costs little beside k products for each, and those of the
iteration before are deleted. Everything else (sums, empty clusters) is the plain iteration's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semprune.functions.arrow import list_matrix, matrix_list
from semprune.operators.assign import BROADCAST_LIMIT, ROW_BLOCK, centroid_shape
from semprune.operators.kmeans import SEED, fit_kmeans, member_sums, moved_by_sums, training_rows
from semprune.session import scratch_path
from semprune.sources.paths import delete

#: Centroids of a group on average, and the most groups; a row keeps a bound for each group.
GROUP_SIZE = 8
MOST_GROUPS = 64
#: Relative rounding error of a product that is allowed for, many times over.
SLACK = 1e-9


@dataclass
class Centroids:
    """Centroids in order of id, cut into groups, with the distances they have moved since bounds were taken."""

    ids: np.ndarray
    matrix: np.ndarray
    group: np.ndarray
    moved: np.ndarray

    def __post_init__(self):
        self.members = [np.flatnonzero(self.group == g) for g in range(self.group.max() + 1)]
        self.place = np.zeros(len(self.ids), np.int64)
        for members in self.members:
            self.place[members] = np.arange(len(members))
        self.group_moved = np.array([self.moved[m].max() for m in self.members])

    def next(self, matrix: np.ndarray) -> Centroids:
        moved = np.sqrt(((matrix - self.matrix) ** 2).sum(axis=1)) * (1 + SLACK)
        return Centroids(self.ids, matrix, self.group, moved)


def centroid_groups(matrix: np.ndarray, n: int) -> np.ndarray:
    """Group of each centroid: the nearest of the first ``n``, which come in random order; groups are numbered without gaps."""
    nearest = np.concatenate([(matrix[at : at + ROW_BLOCK] @ matrix[:n].T).argmax(axis=1) for at in range(0, len(matrix), ROW_BLOCK)])
    return np.unique(nearest, return_inverse=True)[1]


def all_products(x: np.ndarray, c: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the nearest centroid, its product, highest product with another one of each group)."""
    top = np.empty((len(x), len(c.members)))
    second, arg = np.full_like(top, -np.inf), np.empty(top.shape, np.int64)
    rows = np.arange(len(x))
    for g, members in enumerate(c.members):
        sims = x @ c.matrix[members].T
        at = sims.argmax(axis=1)
        top[:, g], arg[:, g] = sims[rows, at], members[at]
        sims[rows, at] = -np.inf
        second[:, g] = sims.max(axis=1)
    best = top.max(axis=1)
    own = np.where(top == best[:, None], arg, len(c.ids)).min(axis=1)
    upper = top
    g = c.group[own]
    upper[rows, g] = second[rows, g]
    return own, best, upper


def tightened(x: np.ndarray, own: np.ndarray, lower: np.ndarray, upper: np.ndarray, c: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(own, lower, upper, products computed) after the centroids have moved."""
    length = np.sqrt(np.einsum("ij,ij->i", x, x))
    slack = SLACK * length
    own = own.copy()
    lower = lower - length * c.moved[own]
    upper = upper + length[:, None] * c.group_moved[None, :]
    products = np.zeros(len(x), np.int64)
    unsure = np.zeros(len(x), bool)
    rows = np.flatnonzero(upper.max(axis=1) >= lower - slack)
    lower[rows] = np.einsum("ij,ij->i", x[rows], c.matrix[own[rows]])
    products[rows] += 1
    rows = rows[upper[rows].max(axis=1) >= lower[rows] - slack[rows]]
    for g, members in enumerate(c.members):
        at = rows[upper[rows, g] >= lower[rows] - slack[rows]]
        if not len(at):
            continue
        sims = x[at] @ c.matrix[members].T
        products[at] += len(members)
        mine = np.flatnonzero(c.group[own[at]] == g)
        sims[mine, c.place[own[at[mine]]]] = -np.inf
        which = sims.argmax(axis=1)
        top = sims[np.arange(len(at)), which]
        upper[at, g] = top
        unsure[at] |= np.abs(top - lower[at]) <= slack[at]
        wins = np.flatnonzero(top > lower[at])
        if len(wins):
            r = at[wins]
            sims[wins, which[wins]] = -np.inf
            upper[r, g] = sims[wins].max(axis=1)
            before = c.group[own[r]]
            upper[r, before] = np.maximum(upper[r, before], lower[r])
            own[r], lower[r] = members[which[wins]], top[wins]
    again = np.flatnonzero(unsure)
    if len(again):
        own[again], lower[again], upper[again] = all_products(x[again], c)
        products[again] += len(c.ids)
    return own, lower, upper, products


def _assign(batches: Iterator[pa.RecordBatch], c: Centroids, first: bool) -> Iterator[pa.RecordBatch]:
    dim = c.matrix.shape[1]
    for whole in batches:
        for begin in range(0, whole.num_rows, ROW_BLOCK):
            batch = whole.slice(begin, ROW_BLOCK)
            x = list_matrix(batch.column("embedding"), dim)
            if np.isnan(x).any():
                raise ValueError("a vector has a component that is no number")
            if first:
                own, lower, upper = all_products(x, c)
                products = np.full(len(x), len(c.ids))
            else:
                own = np.searchsorted(c.ids, batch.column("cid").to_numpy())
                lower, upper = batch.column("lower").to_numpy(), list_matrix(batch.column("upper"), len(c.members))
                own, lower, upper, products = tightened(x, own, lower, upper, c)
            columns = [batch.column("embedding"), pa.array(c.ids[own], pa.int32()), pa.array(lower), matrix_list(upper, pa.float64()), pa.array(products)]
            yield pa.RecordBatch.from_arrays(columns, names=["embedding", "cid", "lower", "upper", "products"])


def _matrix(centroids: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    table = centroids.select("cid", "centroid").toArrow().sort_by("cid")
    return table.column("cid").to_numpy(), list_matrix(table.column("centroid"), dim)


def fit_kmeans_bounded(
    vectors: DataFrame, k: int, n_iter: int = 40, seed: int = SEED, broadcast_limit: int = BROADCAST_LIMIT
) -> tuple[DataFrame, DataFrame]:
    """The centroids of ``fit_kmeans``, and (iteration, products, all_products): products computed, and rows times k.

    Centroids are broadcast; beyond ``broadcast_limit`` bytes the plain iteration is taken, and nothing is skipped.
    """
    spark = vectors.sparkSession
    sample, n, centroids = training_rows(vectors, k, seed)
    _, dim = centroid_shape(centroids)
    counts = "iteration int, products long, all_products long"
    if 8 * k * dim > broadcast_limit:
        plain = spark.createDataFrame([(i, n * k, n * k) for i in range(n_iter)], counts)
        return fit_kmeans(vectors, k, n_iter, seed, broadcast_limit), plain
    embedding = T.StructField("embedding", sample.schema["embedding"].dataType)
    known = T.StructType.fromDDL("cid int, lower double, upper array<double>, products bigint")
    state, held, path, report = sample.select("embedding"), None, None, []
    for i in range(n_iter):
        ids, matrix = _matrix(centroids, dim)
        if held is None:
            held = Centroids(ids, matrix, centroid_groups(matrix, min(MOST_GROUPS, -(-k // GROUP_SIZE))), np.zeros(k))
        else:
            held = held.next(matrix)
        shared = spark.sparkContext.broadcast(held)
        first = i == 0
        assigned = state.mapInArrow(lambda b, shared=shared, first=first: _assign(b, shared.value, first), T.StructType([embedding, *known.fields]))
        before, path = path, scratch_path(spark, "rows-with-bounds")
        assigned.write.parquet(path)
        state = spark.read.schema(assigned.schema).parquet(path)
        shared.destroy()
        if before:
            delete(spark, before)
        report.append((i, state.agg(F.sum("products")).first()[0], n * k))
        centroids = moved_by_sums(member_sums(state, dim), centroids, k)
    if path:
        delete(spark, path)
    fitted = centroids.select(F.col("cid").cast("int").alias("cid"), F.col("centroid").cast("array<float>").alias("centroid"))
    return fitted, spark.createDataFrame(report, counts)

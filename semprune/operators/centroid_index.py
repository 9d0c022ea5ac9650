"""A two-level index over centroids, searched exactly, and kept together with the centroids it was made from.

Centroids are put into groups around pivots. A group has a centre and a radius, so that the product of a row with any of its
centroids is at most the product with the centre plus the length of the row times the radius. A row takes the products with all
centres, then with the centroids of its most promising group, and then only with groups whose bound reaches the best so
far. Where another centroid comes as near as rounding can tell, the row is compared with all, so that results, ties included, are those of
``assign_nearest``.

The index holds numbers and ids, no copy of the centroids, and a digest of the centroids; an index of other centroids is rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semprune.functions.arrow import list_matrix
from semprune.functions.vectors import squared_distance
from semprune.operators.assign import BROADCAST_LIMIT, ROW_BLOCK, assign_nearest, best_match, centroid_shape, result_schema
from semprune.operators.joins import join_counts
from semprune.operators.positions import position_by_order
from semprune.session import materialize

#: Relative rounding error of a product that is allowed for, many times over.
SLACK = 1e-9


def centroids_digest(centroids: DataFrame) -> DataFrame:
    """One row (k, digest): the number of centroids and a sum over the hashes of all."""
    hashed = F.xxhash64(F.col("cid").cast("long"), F.col("centroid").cast("array<double>"))
    return centroids.agg(F.count("*").alias("k"), F.coalesce(F.sum(hashed.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("digest"))


def build_index(centroids: DataFrame, n_groups: int | None = None, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """(grp, cid, centre, radius, k, digest): a row for each centroid; ``centre`` is given once a group, at its lowest ``cid``.

    Every n-th centroid is a pivot; by default there are about as many groups as centroids in a group.
    """
    centroids = materialize(centroids.select("cid", F.col("centroid").cast("array<double>").alias("centroid")), "centroids")
    k, _ = centroid_shape(centroids)
    step = math.ceil(k / min(k, n_groups or math.isqrt(k - 1) + 1))
    placed = materialize(position_by_order(centroids, [], [F.col("cid")], "place"), "centroids-placed")
    pivots = placed.where(F.col("place") % step == 0).select(F.col("place").cast("int").alias("cid"), "centroid")
    rows = placed.select(F.col("cid").alias("id"), F.col("centroid").alias("embedding"))
    found = assign_nearest(rows, pivots, ["id", "embedding"], broadcast_limit).select(F.col("cid").alias("grp"), F.col("id").alias("cid"), "embedding")
    found = materialize(found, "centroids-grouped")
    centres = found.groupBy("grp").agg(vector_to_array(Summarizer.mean(array_to_vector("embedding"))).alias("centre"), F.min("cid").alias("first"))
    both = materialize(join_counts(found, centres, ["grp"]).withColumn("far", F.sqrt(squared_distance(F.col("embedding"), F.col("centre")))), "centroids-measured")
    radii = both.groupBy("grp").agg(F.max("far").alias("radius"))
    made = centroids_digest(centroids).first()
    centre = F.when(F.col("cid") == F.col("first"), F.col("centre"))
    index = join_counts(both, radii, ["grp"]).select("grp", "cid", centre.alias("centre"), "radius")
    return index.withColumns({"k": F.lit(made.k), "digest": F.lit(made.digest)})


@dataclass
class Groups:
    """Centroids in order of id and the groups of their places."""

    ids: np.ndarray
    matrix: np.ndarray
    members: list[np.ndarray]
    centres: np.ndarray
    radius: np.ndarray


def _loaded(centroids: DataFrame, index: DataFrame, dim: int) -> Groups:
    table = centroids.select("cid", F.col("centroid").cast("array<double>").alias("centroid")).toArrow().sort_by("cid")
    ids = table.column("cid").to_numpy()
    rows = index.select("grp", "cid", "radius").toArrow().sort_by([("grp", "ascending"), ("cid", "ascending")])
    heads = index.where("centre IS NOT NULL").select("grp", "centre").toArrow().sort_by("grp")
    grp = rows.column("grp").to_numpy()
    edges = np.flatnonzero(np.r_[True, np.diff(grp) != 0, True])
    places = np.searchsorted(ids, rows.column("cid").to_numpy())
    members = [places[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    return Groups(ids, list_matrix(table.column("centroid"), dim), members, list_matrix(heads.column("centre"), dim), rows.column("radius").to_numpy()[edges[:-1]])


def search(x: np.ndarray, g: Groups) -> tuple[np.ndarray, np.ndarray, int]:
    """(best product, place of its centroid, products computed) of each row."""
    if np.isnan(x).any():
        raise ValueError("a vector has a component that is no number")
    n = len(x)
    length = np.sqrt(np.einsum("ij,ij->i", x, x))
    slack = SLACK * length
    bound = x @ g.centres.T + length[:, None] * (g.radius * (1 + SLACK))[None, :] + slack[:, None]
    products = bound.size
    best, place = np.full(n, -np.inf), np.zeros(n, np.int64)
    unsure = np.zeros(n, bool)

    def compare(rows: np.ndarray, members: np.ndarray) -> None:
        nonlocal products
        sims = x[rows] @ g.matrix[members].T
        products += sims.size
        top = sims.max(axis=1)
        at = sims.argmax(axis=1)
        near = sims >= (top - slack[rows])[:, None]
        unsure[rows] |= (near.sum(axis=1) > 1) | (np.abs(top - best[rows]) <= slack[rows])
        wins = top > best[rows]
        # what was unsure about a product that is beaten clearly does not matter
        clear = wins & (top > best[rows] + slack[rows]) & (near.sum(axis=1) == 1)
        unsure[rows[clear]] = False
        best[rows[wins]], place[rows[wins]] = top[wins], members[at[wins]]

    first = bound.argmax(axis=1)
    for group, members in enumerate(g.members):
        rows = np.flatnonzero(first == group)
        if len(rows):
            compare(rows, members)
    for group, members in enumerate(g.members):
        rows = np.flatnonzero((first != group) & (bound[:, group] >= best - slack))
        if len(rows):
            compare(rows, members)
    again = np.flatnonzero(unsure)
    if len(again):
        best[again], place[again] = best_match(x[again], g.matrix)
        products += len(again) * len(g.ids)
    return best, place, products


def assign_indexed(vectors: DataFrame, centroids: DataFrame, index: DataFrame, keep: list[str] | None = None, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``assign_nearest`` through the index; beyond ``broadcast_limit`` bytes of centroids, without it."""
    k, dim = centroid_shape(centroids)
    if 8 * k * dim > broadcast_limit:
        return assign_nearest(vectors, centroids, keep, broadcast_limit)
    keep = keep or [c for c in vectors.columns if c not in ("embedding", "cid", "centroid_sim")]
    shared = vectors.sparkSession.sparkContext.broadcast(_loaded(centroids, index, dim))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = shared.value
        for whole in batches:
            for begin in range(0, whole.num_rows, ROW_BLOCK):
                batch = whole.slice(begin, ROW_BLOCK)
                best, place, _ = search(list_matrix(batch.column("embedding"), dim), groups)
                columns = [batch.column(name) for name in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(groups.ids[place], pa.int32()), pa.array(best)], names=[*keep, "cid", "centroid_sim"])

    return vectors.select(*keep, *([] if "embedding" in keep else ["embedding"])).mapInArrow(score, result_schema(vectors, keep))

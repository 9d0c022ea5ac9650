"""Cluster membership tables: (cid, ord, idx, uid)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semprune.functions.vectors import dot, squared_distance
from semprune.operators.assign import BROADCAST_LIMIT, centroid_shape
from semprune.operators.positions import position_by_key, position_by_order

# Join keys a cluster is spread over when its centroid cannot be broadcast.
SALTS = 64


def order_members(assigned: DataFrame) -> DataFrame:
    """Order inside a cluster is ascending ``idx``: (cid, idx, uid) -> (cid, ord, idx, uid)."""
    return position_by_key(assigned.select("cid", "idx", "uid"), ["cid"], "idx", "ord").select("cid", "ord", "idx", "uid")


def cluster_sizes(centroids: DataFrame, members: DataFrame) -> DataFrame:
    """One row per centroid, clusters without members included."""
    sizes = members.groupBy("cid").agg(F.count("*").alias("n_members"))
    return centroids.select("cid").join(sizes, "cid", "left").select(
        "cid", F.coalesce("n_members", F.lit(0)).cast("long").alias("n_members")
    )


def member_lists(centroids: DataFrame, members: DataFrame, page_rows: int = 10_000) -> DataFrame:
    """Nested view (cid, page, inds, labels); every list holds at most ``page_rows`` members.

    A cluster without members has one page of empty lists.
    """
    paged = members.withColumn("page", F.floor(F.col("ord") / page_rows).cast("long"))
    row = F.struct("ord", "idx", "uid")
    pages = paged.groupBy("cid", "page").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    nested = centroids.select("cid").join(pages, "cid", "left")
    return nested.select(
        "cid",
        F.coalesce("page", F.lit(0)).cast("long").alias("page"),
        F.coalesce(F.col("rows.idx"), F.array().cast("array<bigint>")).alias("inds"),
        F.coalesce(F.col("rows.uid"), F.array().cast(f"array<{members.schema['uid'].dataType.simpleString()}>")).alias(
            "labels"
        ),
    )


def attach_uids(members: DataFrame, id_map: DataFrame) -> DataFrame:
    """Look up the uid of every member by ``idx``; an index without a uid fails the job."""
    joined = members.drop("uid").join(id_map.select("idx", "uid"), "idx", "left")
    missing = F.raise_error(F.concat(F.lit("no uid for index "), F.col("idx").cast("string")))
    checked = F.when(F.col("uid").isNull(), missing).otherwise(F.col("uid"))
    return joined.withColumn("uid", checked)


def first_clusters(members: DataFrame, n_clusters: int = -1) -> DataFrame:
    """Only the first ``n_clusters`` clusters, as an estimate; -1 means all."""
    return members if n_clusters < 0 else members.where(F.col("cid") < n_clusters)


def centroid_distance(metric: str) -> Column:
    """Distance between the columns ``embedding`` and ``centroid``."""
    if metric == "cosine":
        return 1 - dot(F.col("embedding"), F.col("centroid"))
    if metric == "l2":
        return squared_distance(F.col("embedding"), F.col("centroid"))
    raise ValueError("metric must be 'cosine' or 'l2'")


def rank_in_cluster(
    vectors: DataFrame,
    centroids: DataFrame,
    metric: str = "cosine",
    keep_hard: bool = True,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Rank (from 1) of every vector in its cluster by distance to the centroid.

    ``vectors(cid, idx, uid, embedding)``; ``keep_hard`` ranks the farthest first.
    """
    k, dim = centroid_shape(centroids)
    table = centroids.select("cid", "centroid")
    if 8 * k * dim <= broadcast_limit:
        near = vectors.join(F.broadcast(table), "cid")
    else:
        # A large cluster is spread over SALTS join keys, so its vectors never meet in one task.
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        salted = vectors.withColumn("salt", F.pmod(F.xxhash64("idx"), F.lit(SALTS)).cast("int"))
        near = salted.join(table.select("*", salts), ["cid", "salt"])
    measured = near.select("cid", "idx", "uid", centroid_distance(metric).alias("distance"))
    first = F.col("distance").desc() if keep_hard else F.col("distance").asc()
    ranked = position_by_order(measured, ["cid"], [first, F.col("idx").asc()], "position")
    return ranked.select("cid", "idx", "uid", "distance", (F.col("position") + 1).alias("rank"))

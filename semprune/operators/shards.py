"""Shard offsets, subsets of clusters and positions inside them.

All running sums are taken over per-shard or per-cluster counts, never over the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semprune.operators.joins import join_counts
from semprune.operators.positions import running_before


def shard_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("shard").agg(F.count("*").alias("n"))


def shard_offsets(rows: DataFrame) -> DataFrame:
    """(shard, n, offset): rows in the shards that come before by name."""
    return shard_sizes(rows).select("shard", "n", running_before("n", [], ["shard"]).alias("offset"))


def merge_shards(rows: DataFrame, index: str = "idx") -> DataFrame:
    """Union of shards with the local index moved behind the earlier shards."""
    offsets = shard_offsets(rows).select("shard", "offset")
    return join_counts(rows, offsets, ["shard"]).withColumn(index, F.col(index) + F.col("offset")).drop("offset")


def merge_member_lists(members: DataFrame) -> DataFrame:
    """Cluster lists of all shards appended in shard order: new ``ord`` per cluster."""
    sizes = members.groupBy("cid", "shard").agg(F.count("*").alias("n"))
    earlier = sizes.select("cid", "shard", running_before("n", ["cid"], ["shard"]).alias("earlier"))
    moved = join_counts(members, earlier, ["cid", "shard"])
    return moved.withColumn("ord", F.col("ord") + F.col("earlier")).drop("earlier")


def subset_of(cid: Column, n_clusters: int, n_subsets: int) -> Column:
    """Subset of a cluster: the last subset whose start ``floor(i * (N / S))`` is not behind it.

    The quotient N / S is taken in double arithmetic, so the integer estimate is only a
    starting point that may be a little high.
    """
    if n_clusters < 1 or n_subsets < 1:
        raise ValueError("n_clusters and n_subsets must be positive")
    step = F.lit(n_clusters / n_subsets)
    found = F.least(F.floor((cid + 1) * n_subsets / n_clusters).cast("int") + 1, F.lit(n_subsets - 1))
    for _ in range(3):
        found = F.when(F.floor(found * step) > cid, found - 1).otherwise(found)
    return found.cast("int")


def cluster_subsets(clusters: DataFrame, n_clusters: int, n_subsets: int) -> DataFrame:
    return clusters.select("cid", subset_of(F.col("cid"), n_clusters, n_subsets).alias("subset"))


def select_members(members: DataFrame, vectors: DataFrame) -> DataFrame:
    """Members that have a vector in the shard table, joined by uid; the others are skipped.

    ``vectors(shard, uid, …)``; the shard of the vector becomes the shard of the member.
    """
    return members.drop("idx", "shard", "embedding").join(vectors, "uid")


def subset_positions(members: DataFrame, n_clusters: int, n_subsets: int, rank: str = "rank") -> DataFrame:
    """Index of every member inside its subset: adds ``subset, pos, subset_idx``.

    ``members(shard, cid, rank, …)`` with ``rank`` the 0-based position in (cid, shard).
    ``pos`` counts inside (subset, shard), clusters in order of ``cid``; ``subset_idx`` moves
    it behind the earlier shards of the subset.
    """
    sizes = members.groupBy("cid", "shard").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("subset", subset_of(F.col("cid"), n_clusters, n_subsets))
    inside = running_before("n", ["subset", "shard"], ["cid"]).alias("cluster_start")
    starts = sizes.select("cid", "shard", "subset", inside)
    per_shard = sizes.groupBy("subset", "shard").agg(F.sum("n").alias("n"))
    offsets = per_shard.select("subset", "shard", running_before("n", ["subset"], ["shard"]).alias("shard_start"))
    places = starts.join(offsets, ["subset", "shard"])
    pos = F.col("cluster_start") + F.col(rank)
    return join_counts(members, places, ["cid", "shard"]).select(
        "subset", *members.columns, pos.alias("pos"), (F.col("shard_start") + pos).alias("subset_idx")
    )


def subset_sizes(members: DataFrame, n_clusters: int, n_subsets: int) -> DataFrame:
    """Rows per (subset, shard); a subset with a single row counts like any other."""
    subset = subset_of(F.col("cid"), n_clusters, n_subsets).alias("subset")
    return members.groupBy(subset, "shard").agg(F.count("*").alias("n"))


def subset_shard_offsets(members: DataFrame, n_clusters: int, n_subsets: int) -> DataFrame:
    """(subset, shard, n, offset): rows of earlier shards inside the subset."""
    sizes = subset_sizes(members, n_clusters, n_subsets)
    return sizes.select("subset", "shard", "n", running_before("n", ["subset"], ["shard"]).alias("offset"))

"""Consistency checks between ids, vectors, clusters and similarities.

Every check is a DataFrame with a column ``ok``; ``require`` turns it into an error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from semprune.functions.vectors import has_nan, is_zero_vector, squared_norm
from semprune.operators.centroid_index import centroids_digest
from semprune.operators.shards import shard_sizes

UNIT_TOLERANCE = 1e-4
# Rows of a failed check shown in the error.
SHOWN_FAILURES = 5


def require(report: DataFrame, what: str) -> None:
    """Raise when a row of the report is not ok."""
    bad = report.where(~F.coalesce("ok", F.lit(False))).limit(SHOWN_FAILURES).collect()
    if bad:
        raise ValueError(f"{what}: {[row.asDict() for row in bad]}")


def _both_sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    a = left.select(key, F.lit(1).alias("in_left"))
    b = right.select(key, F.lit(1).alias("in_right"))
    return a.join(b, key, "full_outer")


def _side_by_side(*rows: DataFrame) -> DataFrame:
    """One-row tables of counts as one row."""
    names = [c for row in rows for c in row.columns]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in names])


def check_counts(ids: DataFrame, vectors: DataFrame) -> DataFrame:
    """Every id has a vector and every vector an id (by ``idx``)."""
    return _both_sides(ids, vectors, "idx").agg(
        F.count("in_left").alias("n_ids"),
        F.count("in_right").alias("n_vectors"),
        F.count_if(F.col("in_right").isNull()).alias("ids_without_vector"),
        F.count_if(F.col("in_left").isNull()).alias("vectors_without_id"),
    ).withColumn("ok", (F.col("ids_without_vector") == 0) & (F.col("vectors_without_id") == 0))


def check_shards(ids: DataFrame, vectors: DataFrame) -> DataFrame:
    """Every shard has ids and vectors, as many of the one as of the other."""
    a = shard_sizes(ids).withColumnRenamed("n", "n_ids")
    b = shard_sizes(vectors).withColumnRenamed("n", "n_vectors")
    joined = a.join(b, "shard", "full_outer")
    return joined.withColumn("ok", F.coalesce(F.col("n_ids") == F.col("n_vectors"), F.lit(False)))


def check_shard_kinds(**kinds: DataFrame) -> DataFrame:
    """Every shard is present in every kind of table: (shard, missing, ok)."""
    names = sorted(kinds)
    present = [kinds[name].select("shard").distinct().withColumn("kind", F.lit(name)) for name in names]
    found = reduce(DataFrame.unionByName, present).groupBy("shard").agg(F.collect_set("kind").alias("found"))
    missing = F.array_join(F.array_sort(F.array_except(F.array(*map(F.lit, names)), "found")), ",")
    return found.select("shard", missing.alias("missing")).withColumn("ok", F.col("missing") == "")


def check_cluster_counts(members: DataFrame) -> DataFrame:
    """Every shard was assigned to the same number of clusters: (shard, n_clusters, ok).

    Takes one row per (shard, cid), empty clusters included.
    """
    counts = members.groupBy("shard").agg((F.max("cid") + 1).cast("long").alias("n_clusters"))
    # One row per shard.
    shards = Window.partitionBy()
    same = F.min("n_clusters").over(shards) == F.max("n_clusters").over(shards)
    return counts.select("shard", "n_clusters", same.alias("ok"))


def check_unique(rows: DataFrame, key: str) -> DataFrame:
    """No value of ``key`` is on several rows."""
    repeated = rows.groupBy(key).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("n_repeated"))
    return repeated.withColumn("ok", F.col("n_repeated") == 0)


def check_bijection(id_map: DataFrame, members: DataFrame) -> DataFrame:
    """idx -> uid and uid -> idx are inverse, and the members agree with both."""

    def ambiguous(key: str, value: str, name: str) -> DataFrame:
        spread = id_map.groupBy(key).agg(F.min(value).alias("low"), F.max(value).alias("high"))
        return spread.agg(F.count_if(F.col("low") != F.col("high")).alias(name))

    pairs = id_map.select("idx", "uid").distinct()
    strangers = members.select("idx", "uid").join(pairs, ["idx", "uid"], "left_anti")
    report = _side_by_side(
        ambiguous("idx", "uid", "ambiguous_idx"),
        ambiguous("uid", "idx", "ambiguous_uid"),
        strangers.agg(F.count("*").alias("wrong_members")),
    )
    return report.withColumn("ok", F.col("ambiguous_idx") + F.col("ambiguous_uid") + F.col("wrong_members") == 0)


def check_member_labels(members: DataFrame, id_map: DataFrame) -> DataFrame:
    """As many labels as indices in the clusters, as many as ids in the map."""
    counts = members.agg(F.count("idx").alias("n_inds"), F.count("uid").alias("n_labels"))
    report = _side_by_side(counts, id_map.agg(F.count("*").alias("n_ids")))
    return report.withColumn("ok", (F.col("n_inds") == F.col("n_labels")) & (F.col("n_labels") == F.col("n_ids")))


def check_similarity_labels(members: DataFrame, scores: DataFrame) -> DataFrame:
    """One similarity per member, cluster by cluster: (cid, n_members, n_scores, ok)."""
    a = members.groupBy("cid").agg(F.count("*").alias("n_members"))
    b = scores.groupBy("cid").agg(F.count("sim").alias("n_scores"))
    joined = a.join(b, "cid", "full_outer")
    return joined.withColumn("ok", F.coalesce(F.col("n_members") == F.col("n_scores"), F.lit(False)))


def check_centroids(centroids: DataFrame) -> DataFrame:
    """Ids 0 … k-1, one dimension, unit length."""
    norm = F.sqrt(squared_norm(F.col("centroid")))
    report = centroids.select("cid", F.size("centroid").alias("d"), norm.alias("norm")).agg(
        F.count("*").alias("k"),
        F.count_distinct("cid").alias("ids"),
        F.min("cid").alias("first"),
        F.max("cid").alias("last"),
        F.min("d").alias("min_dim"),
        F.max("d").alias("max_dim"),
        F.max(F.abs(F.col("norm") - 1)).alias("norm_gap"),
    )
    numbered = (F.col("ids") == F.col("k")) & (F.col("first") == 0) & (F.col("last") == F.col("k") - 1)
    shaped = (F.col("min_dim") == F.col("max_dim")) & (F.col("norm_gap") <= UNIT_TOLERANCE)
    return report.withColumn("ok", numbered & shaped)


def check_centroid_index(centroids: DataFrame, index: DataFrame) -> DataFrame:
    """The index was made from these centroids and lists each of them once."""
    made = centroids_digest(centroids)
    listed = index.agg(
        F.count("*").alias("n_listed"),
        F.count_distinct("cid").alias("n_ids"),
        F.min("k").alias("index_k"),
        F.min("digest").alias("low"),
        F.max("digest").alias("high"),
    )
    report = _side_by_side(made, listed)
    whole = (F.col("n_listed") == F.col("k")) & (F.col("n_ids") == F.col("k")) & (F.col("index_k") == F.col("k"))
    same = F.coalesce((F.col("low") == F.col("digest")) & (F.col("high") == F.col("digest")), F.lit(False))
    return report.select("k", "n_listed", (F.coalesce(whole, F.lit(False)) & same).alias("ok"))


def check_vectors(vectors: DataFrame) -> DataFrame:
    """Zero vectors, vectors with NaN or null components, and vectors that are not of unit length."""
    v = F.col("embedding")
    traits = vectors.select(
        is_zero_vector(v).alias("zero"), has_nan(v).alias("nan"), (F.abs(squared_norm(v) - 1) > UNIT_TOLERANCE).alias("off")
    )
    report = traits.agg(
        F.count("*").alias("n_vectors"),
        F.count_if("zero").alias("n_zero"),
        F.count_if("nan").alias("n_nan"),
        F.count_if(F.col("off") & ~F.col("zero") & ~F.col("nan")).alias("n_not_unit"),
    )
    return report.withColumn("ok", (F.col("n_nan") == 0) & (F.col("n_not_unit") == 0))

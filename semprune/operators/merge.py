"""Merging results that arrive in shards: similarities, quantile thresholds, kept sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONFLICT_RULES = ("last", "max", "error")


def resolve_duplicates(scores: DataFrame, rule: str = "last") -> DataFrame:
    """One similarity per uid: ``last`` by (shard, cid, ord), ``max``, or ``error`` on any repeat.

    ``ord`` is the position inside a cluster of a shard; what is not there does not decide, and
    among rows at one place the largest value is taken.
    """
    if rule not in CONFLICT_RULES:
        raise ValueError(f"rule must be one of {CONFLICT_RULES}")
    if rule == "max":
        value = F.max("sim")
    elif rule == "error":
        repeated = F.raise_error(F.concat(F.lit("repeated uid "), F.first("uid").cast("string")))
        value = F.when(F.count("*") > 1, repeated).otherwise(F.max("sim"))
    else:
        place = [c for c in ("shard", "cid", "ord") if c in scores.columns]
        value = F.max_by("sim", F.struct(*place, "sim"))
    return scores.groupBy("uid").agg(value.alias("sim"))


def merge_similarities(scores: DataFrame) -> DataFrame:
    """Union of similarity shards; on an equal uid the later shard wins."""
    return resolve_duplicates(scores, "last")


def kept_set(scores: DataFrame, threshold: float) -> DataFrame:
    """Distinct uids that any shard has strictly below the threshold."""
    return scores.where(F.col("sim") < F.lit(threshold)).select("uid").distinct()


def kept_counts(scores: DataFrame, threshold: float) -> DataFrame:
    """Kept and removed counts per occurrence (not per distinct uid) and the kept share."""
    below = F.coalesce(F.col("sim") < F.lit(threshold), F.lit(False))
    counts = scores.agg(F.count_if(below).alias("kept"), F.count_if(~below).alias("removed"))
    return counts.withColumn("kept_share", F.try_divide("kept", F.col("kept") + F.col("removed")))

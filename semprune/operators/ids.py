"""Index <-> uid mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semprune.operators.prune import uid_column


def id_map(df: DataFrame, uid_key: str | None = None) -> DataFrame:
    return df.select("idx", uid_column(df, uid_key).alias("uid"))


def invert_ids(mapping: DataFrame) -> DataFrame:
    """(idx, uid) -> (uid, idx); a uid on several rows keeps the last index."""
    return mapping.groupBy("uid").agg(F.max("idx").alias("idx"))

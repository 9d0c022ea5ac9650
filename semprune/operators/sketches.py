"""Quantiles of shards from mergeable sketches, with a bound of the rank error.

A sketch (KLL) of the scores of a shard is stored beside them. Sketches are merged without reading scores again, and a quantile of the
merged one is a score whose rank is off by at most ``rank_error`` of all rows, with a confidence of 99%; a sketch of fewer rows than
``k`` is exact. The exact form and the mean weighted by shard sizes are in ``quantiles``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semprune.operators.quantiles import DEFAULT_QUANTILES
from semprune.session import materialize

#: Items of the highest level of a sketch; it has about three times as many in all.
ITEMS = 1024


def rank_error(k: int = ITEMS) -> float:
    """Published error of a rank in a sketch with parameter ``k``, at 99% confidence."""
    return 2.296 / k**0.9021


def sketches(scores: DataFrame, group: list[str] | None = None, column: str = "sim", k: int = ITEMS) -> DataFrame:
    """(group…, k, n, sketch): one row of a few kilobytes for each group; rows without a value have no part."""
    rows = scores.select(*(group or []), F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    found = rows.groupBy(*(group or [])).agg(F.count("*").alias("n"), F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch"))
    return found.where("n > 0").select(*(group or []), F.lit(k).alias("k"), "n", "sketch")


def merge_sketches(stored: DataFrame) -> DataFrame:
    """One row for all sketches; ``k`` is the smallest of theirs, which decides the error."""
    merged = stored.agg(F.min("k").alias("k"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.where("n > 0")


def sketch_quantiles(sketch: DataFrame, points: list[float] | None = None) -> DataFrame:
    """(q, value, low, high): the quantile, and scores between which the exact one lies by the bound."""
    points = DEFAULT_QUANTILES if points is None else [float(q) for q in points]
    sketch = materialize(sketch, "merged-sketch")
    size = sketch.select("k", "n").first()
    if size is None:
        return sketch.sparkSession.createDataFrame([], "q double, value double, low double, high double")
    error = (rank_error(size.k) if size.n > size.k else 0.0) + 1 / size.n

    def at(shift: float) -> Column:
        """Scores at all points, shifted; Spark wants ranks as constants."""
        return F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(min(max(q + shift, 0.0), 1.0)) for q in points]))

    lists = F.arrays_zip(F.array(*map(F.lit, points)).alias("q"), at(0.0).alias("value"), at(-error).alias("low"), at(error).alias("high"))
    return sketch.select(F.explode(lists).alias("x")).select("x.q", "x.value", "x.low", "x.high")

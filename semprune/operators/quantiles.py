"""Exact order statistics and quantiles, distributed; merged shard quantiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semprune.operators.joins import join_counts
from semprune.operators.positions import running_before
from semprune.session import materialize

DEFAULT_QUANTILES = [round(0.05 * i, 2) for i in range(1, 20)]
# Cells of a histogram, and most rows of a cell that are put in order.
CELLS = 1 << 16
ORDER_ROWS = 1 << 16
QUANTILE_TOLERANCE = 1e-9


def _within(rows: DataFrame, targets: DataFrame, group: list[str]) -> DataFrame:
    """Rows inside a target, with its ``lo``, ``hi``, ``before`` and ``wanted`` as ``t``.

    Without a group there are as many targets as ranks at most, and they become literals.
    """
    bounds = F.struct("lo", "hi", "before", "wanted")
    inside = lambda t: (F.col("_v") >= t["lo"]) & (F.col("_v") <= t["hi"])
    if group:
        listed = targets.groupBy(*group).agg(F.collect_list(bounds).alias("_targets"))
        return join_counts(rows, listed, group).select(*group, "_v", F.explode(F.filter("_targets", inside)).alias("t"))
    kind = T.ArrayType(targets.select(bounds.alias("t")).schema["t"].dataType)
    found = targets.select(F.to_json(bounds).alias("t")).collect()
    text = "[" + ",".join(row.t for row in found) + "]"
    known = F.from_json(F.lit(text), kind)
    return rows.select("_v", F.explode(F.filter(known, inside)).alias("t"))


def values_at(values: DataFrame, column: str, ranks: Column, group: list[str] | None = None) -> DataFrame:
    """Exact values at given 0-based ranks -> (group…, label, value).

    ``ranks`` is an ARRAY<STRUCT<label, rank BIGINT>> that may use the column ``total``. A histogram
    of a fixed number of cells between the lowest and the highest value, counted before any shuffle,
    finds the cells that hold the ranks. A cell of more than ``ORDER_ROWS`` rows, such as the scores of many copies,
    gets a histogram of its own, and so on, until a cell is one value or small enough to be put in order.
    """
    group = group or []
    rows = values.select(*group, F.col(column).alias("_v")).where(F.col("_v").isNotNull())
    extent = rows.groupBy(*group).agg(F.count("*").alias("total"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    targets = extent.where("total > 0").select(*group, "lo", "hi", F.lit(0).cast("long").alias("before"), F.col("total").alias("n"), ranks.alias("wanted"))
    results: list[DataFrame] = []

    def hits(found: DataFrame, value: str) -> DataFrame:
        return found.select(*group, F.explode("wanted").alias("hit"), F.col(value).alias("value")).select(*group, "hit.label", "value")

    def holding(before: Column, size: str) -> Column:
        return F.filter("wanted", lambda r: (r["rank"] >= before) & (r["rank"] < before + F.col(size)))

    while True:
        targets = materialize(targets, "quantile-cells")
        results.append(hits(targets.where("lo = hi"), "lo"))
        small, large = (targets.where(f"lo < hi AND n {test} {ORDER_ROWS}") for test in ("<=", ">"))
        if small.limit(1).count():
            counts = _within(rows, small, group).groupBy(*group, F.col("t.lo").alias("lo"), "_v").agg(F.count("*").alias("_c"), F.first("t").alias("t"))
            placed = counts.withColumn("_before", F.col("t.before") + running_before("_c", [*group, "lo"], ["_v"]))
            ordered = placed.withColumn("wanted", F.col("t.wanted")).withColumn("wanted", holding(F.col("_before"), "_c"))
            results.append(hits(ordered, "_v"))
        if not large.limit(1).count():
            break
        cell = F.floor((F.col("_v") - F.col("t.lo")).cast("double") / (F.col("t.hi") - F.col("t.lo")).cast("double") * (CELLS - 1)).cast("int")
        counted = _within(rows, large, group).select(*group, F.col("t.lo").alias("_of"), "_v", cell.alias("_cell"))
        cells = counted.groupBy(*group, "_of", "_cell").agg(F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        # One row for each cell: at most CELLS in a window.
        cells = cells.withColumn("_earlier", running_before("n", [*group, "_of"], ["_cell"]))
        parents = large.select(*group, F.col("lo").alias("_of"), F.col("before").alias("_start"), "wanted")
        joined = cells.join(parents, [*group, "_of"]).withColumn("before", F.col("_start") + F.col("_earlier"))
        targets = joined.select(*group, "lo", "hi", "before", "n", holding(F.col("before"), "n").alias("wanted")).where(F.size("wanted") > 0)
    return reduce(DataFrame.unionByName, results)


def quantiles(
    scores: DataFrame, points: list[float] | None = None, column: str = "sim", group: list[str] | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation over all rows -> (group…, q, value)."""
    group = group or []
    points = DEFAULT_QUANTILES if points is None else [float(q) for q in points]

    def around(q: Column) -> Column:
        """The two ranks between which the quantile lies."""
        spot = q * (F.col("total") - 1)

        def rank(high: bool) -> Column:
            place = F.ceil(spot) if high else F.floor(spot)
            label = F.struct(q.alias("q"), F.lit(high).alias("high"), (spot - F.floor(spot)).alias("weight"))
            return F.struct(label.alias("label"), place.cast("long").alias("rank"))

        return F.array(rank(False), rank(True))

    ranks = F.flatten(F.transform(F.lit(points), around))
    found = values_at(scores, column, ranks, group)
    lower, upper = (F.max(F.when(F.col("label.high") == high, F.col("value"))) for high in (False, True))
    bounds = found.groupBy(*group, F.col("label.q").alias("q")).agg(
        lower.alias("lower"), upper.alias("upper"), F.max("label.weight").alias("weight")
    )
    value = F.col("lower") + (F.col("upper") - F.col("lower")) * F.col("weight")
    return bounds.select(*group, "q", value.alias("value"))


def shard_quantiles(scores: DataFrame, points: list[float] | None = None, column: str = "sim") -> DataFrame:
    """Exact quantiles per shard with the number of distinct uids -> (shard, n, q, value)."""
    sizes = scores.groupBy("shard").agg(F.count_distinct("uid").alias("n"))
    return quantiles(scores, points, column, ["shard"]).join(sizes, "shard").select("shard", "n", "q", "value")


def merge_quantiles(per_shard: DataFrame) -> DataFrame:
    """Quantiles of the union estimated as the mean over shards weighted by shard size."""
    weighted = F.sum(F.col("value") * F.col("n")) / F.sum("n")
    return per_shard.groupBy("q").agg(weighted.alias("value"))


def thresholds_at(quantile_table: DataFrame, fractions: list[float]) -> list[float]:
    """Values stored for quantile points; an unknown point is an error that lists the known ones."""
    known = {row.q: row.value for row in quantile_table.select("q", "value").collect()}

    def value_of(fraction: float) -> float:
        for q, value in known.items():
            if abs(q - fraction) < QUANTILE_TOLERANCE:
                return value
        raise KeyError(f"quantile {fraction} is not available; use one of {sorted(known)}")

    return [value_of(fraction) for fraction in fractions]


def threshold_at(quantile_table: DataFrame, fraction: float) -> float:
    return thresholds_at(quantile_table, [fraction])[0]

"""Positions of rows inside groups, without ever ordering a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from semprune.operators.joins import join_counts
from semprune.session import materialize

# Keys for each row beyond which keys count as sparse.
SPARSE = 8
# Keys per slice: the most rows one task orders at once in ``position_by_key``.
SLICE_WIDTH = 1 << 18


def running_before(value: str | Column, partition: list, order: list) -> Column:
    """Sum of ``value`` over the preceding rows of the partition (0 for the first)."""
    frame = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(frame), F.lit(0)).cast("long")


def position_by_key(
    df: DataFrame,
    group: list[str],
    key: str,
    out: str,
    size_out: str | None = None,
    width: int = SLICE_WIDTH,
) -> DataFrame:
    """0-based position by a unique integer key inside each group.

    Dense keys: the key range is cut into slices of ``width`` keys. Rows are numbered inside
    (group, slice), which holds at most ``width`` rows however large the group is, and
    the sizes of the earlier slices are added. Sparse keys, such as hashes, would make a slice
    of every row; their rows are range-partitioned instead. ``size_out`` adds the size of the group.
    Keep ``df`` narrow: its columns travel through the shuffle.
    """
    extent = df.agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).first()
    if extent.n and extent.high - extent.low > SPARSE * max(extent.n, width):
        placed = position_by_order(df, group, [F.col(key)], out)
        if not size_out:
            return placed
        sizes = placed.groupBy(*group).agg((F.max(out) + 1).alias(size_out))
        return join_counts(placed, sizes, group) if group else placed.withColumn(size_out, F.lit(extent.n))
    sliced = df.withColumn("_slice", F.floor(F.col(key) / width).cast("long"))
    cell = [*group, "_slice"]
    numbered = sliced.withColumn("_local", F.row_number().over(Window.partitionBy(*cell).orderBy(key)) - 1)
    # The same exchange as `numbered` feeds this aggregate, so the input is read once.
    sizes = numbered.groupBy(*cell).agg((F.max("_local") + 1).alias("_n"))
    offsets = sizes.select(
        *cell,
        running_before("_n", group, ["_slice"]).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*group)).alias("_size"),
    )
    extra = [F.col("_size").alias(size_out)] if size_out else []
    return numbered.join(offsets, cell).select(
        *df.columns, (F.col("_before") + F.col("_local")).cast("long").alias(out), *extra
    )


def position_by_order(df: DataFrame, group: list[str], order: list[Column], out: str) -> DataFrame:
    """0-based position inside each group under any total order.

    Rows are range-partitioned on (group, order), so a hot group spreads over many
    partitions; the sorted partitions are written once (range bounds come from a sample,
    so they must not be recomputed) and each partition then only needs the number of rows
    of its group in earlier partitions.
    """
    spread = [F.col(c) for c in group] + order
    placed = df.repartitionByRange(*spread).sortWithinPartitions(*spread)
    placed = placed.withColumn("_row", F.monotonically_increasing_id())
    placed = materialize(placed, "ordered").withColumn("_part", F.shiftright("_row", 33))
    runs = placed.groupBy("_part", *group).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    # One row per partition a group touches.
    runs = runs.select("_part", *group, "_first", running_before("_n", group, ["_part"]).alias("_before"))
    return join_counts(placed, runs, ["_part", *group]).select(
        *df.columns, (F.col("_row") - F.col("_first") + F.col("_before")).cast("long").alias(out)
    )


def number_rows(df: DataFrame, out: str = "idx") -> DataFrame:
    """Contiguous 0-based index by (file path, row in file) for a scan of files in any format.

    Rows leave a split in the order of the file, and splits are ordered by where they begin, so the
    number does not depend on how files are split. The rows are written once with their place.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    placed = materialize(placed, "numbered")
    runs = placed.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    # One row per split.
    runs = runs.select("_file", "_block", "_first", running_before("_n", [], ["_file", "_block"]).alias("_before"))
    return join_counts(placed, runs, ["_file", "_block"]).select(
        (F.col("_row") - F.col("_first") + F.col("_before")).cast("long").alias(out), *df.columns
    )

"""Joins of many rows with a table of counts or offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semprune.session import materialize

# Most rows of a narrow lookup table that are broadcast.
SMALL_ROWS = 1 << 20


def join_counts(rows: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join with a narrow table that has one row per key.

    The table is written and counted; up to ``SMALL_ROWS`` rows it is broadcast, so ``rows`` is
    not shuffled and a hot key does no harm. A larger one is joined by shuffle, where adaptive
    execution splits partitions with a hot key.
    """
    counts = materialize(counts, "counts")
    return rows.join(F.broadcast(counts) if counts.count() <= SMALL_ROWS else counts, keys)

"""Two-pass external shuffle: a uniform random order of all rows, cut into shards of equal row counts.

Pass one scatters the rows into memory-sized buckets by a seeded hash and writes them to the shared
folder. Pass two brings a bucket into one row, runs Fisher-Yates over it (Spark's ``shuffle``) and
places it behind the buckets before it. Independent uniform bucket numbers and a uniform permutation
of each bucket make a uniform permutation of the whole. All steps are DataFrame operations.

The hash takes the position of a row in the input, not its content, so copies spread like any other
rows. Because the first pass is written, its hashes stay as they are when an executor is lost.

Defined cases: a missing text has no bytes; repeated rows each keep a place; an empty table stays empty;
columns of any name are kept, but ``shard`` and ``slot``, which this operator sets, replace such columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from semprune.session import materialize

SEED = 20_240_501
BUCKET_BYTES = 16 << 20


def record_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text plus one; nulls have none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def bucket_count(df: DataFrame, bytes_of: Column, bucket_bytes: int) -> int:
    """Buckets of about ``bucket_bytes``, at least one for each shuffle partition."""
    total = df.agg(F.sum(bytes_of)).first()[0] or 0
    return max(math.ceil(total / bucket_bytes), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def shuffle_into_shards(df: DataFrame, n_shards: int, bytes_of: Column, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows with ``shard`` (0 to n_shards - 1) and ``slot`` (0, 1, ... in the shard), in random order.

    Row counts of shards differ by one at most. ``bytes_of`` is the size of a row; a bucket must fit into
    memory, and holds ``bucket_bytes`` on average.
    """
    n_buckets = bucket_count(df, bytes_of, bucket_bytes)
    df = df.drop("shard", "slot")
    ticket = F.xxhash64(F.lit(seed), F.monotonically_increasing_id())
    scattered = df.select(F.struct("*").alias("record"), ticket.alias("ticket"))
    scattered = materialize(scattered.withColumn("bucket", F.pmod("ticket", F.lit(n_buckets))), "scattered")

    by_ticket = lambda a, b: F.when(a["ticket"] < b["ticket"], -1).when(a["ticket"] > b["ticket"], 1).otherwise(0)
    buckets = scattered.groupBy("bucket").agg(F.collect_list(F.struct("ticket", "record")).alias("rows"))
    permuted = F.shuffle(F.array_sort("rows", by_ticket), seed)
    sizes = scattered.groupBy("bucket").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    places = sizes.select("bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(everything).alias("total"))
    placed = buckets.join(places, "bucket").select("before", "total", F.posexplode(permuted).alias("at", "row"))

    place = F.col("before") + F.col("at")
    placed = placed.select("row.record", "total", place.alias("place"), F.expr(f"(before + at) * {n_shards} div total").alias("shard"))
    first = F.expr(f"(shard * total + {n_shards} - 1) div {n_shards}")
    return placed.select("record.*", F.col("shard").cast("int").alias("shard"), (F.col("place") - first).alias("slot"))


def write_shards(shards: DataFrame, path: str) -> None:
    """One directory for each shard; rows keep their order by ``slot``."""
    shards.write.partitionBy("shard").parquet(path)

"""Kept sets as pages of bits: stored for each shard, merged, counted and used to prune as they are.

A page holds 32,768 neighbouring integer uids, one bit each, beside the numbers of kept and of all rows that it stands for. Merged
sets and their counts come from pages alone, without the scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits and bytes of a page, as Spark's bitmap functions have them.
PAGE_BITS = 32768
PAGE_BYTES = 4096


def kept_pages(scores: DataFrame, threshold: float) -> DataFrame:
    """(shard, page, bits, kept, rows) of ``scores(shard, uid, sim)``; a page without kept rows has bits that are all 0."""
    below = F.coalesce(F.col("sim") < F.lit(threshold), F.lit(False))
    rows = scores.where(F.col("uid").isNotNull()).select("shard", F.col("uid").cast("long").alias("uid"), below.alias("below"))
    page = F.bitmap_bucket_number("uid")
    bits = F.bitmap_construct_agg(F.when(F.col("below"), F.bitmap_bit_position("uid")))
    return rows.groupBy("shard", page.alias("page")).agg(bits.alias("bits"), F.count_if("below").alias("kept"), F.count("*").alias("rows"))


def merged_pages(pages: DataFrame) -> DataFrame:
    """(page, bits): the uids that any shard keeps."""
    return pages.where("kept > 0").groupBy("page").agg(F.bitmap_or_agg("bits").alias("bits"))


def page_counts(pages: DataFrame) -> DataFrame:
    """Kept and removed counts per occurrence, the kept share, and the number of distinct kept uids; one row."""
    whole = merged_pages(pages).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("distinct_kept"))
    sums = pages.agg(F.coalesce(F.sum("kept"), F.lit(0)).alias("kept"), F.coalesce(F.sum(F.col("rows") - F.col("kept")), F.lit(0)).alias("removed"))
    share = F.try_divide("kept", F.col("kept") + F.col("removed"))
    return sums.withColumn("kept_share", share).join(whole, F.lit(True))


def page_uids(pages: DataFrame) -> DataFrame:
    """(uid) of the bits that are set."""
    byte = F.conv(F.hex(F.substring("bits", F.col("at") + 1, F.lit(1))), 16, 10).cast("int")
    bytes_ = pages.select("page", "bits", F.explode(F.sequence(F.lit(0), F.lit(PAGE_BYTES - 1))).alias("at")).select("page", "at", byte.alias("byte"))
    bits = bytes_.where("byte <> 0").select("page", "byte", "at", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit")).where(F.getbit("byte", F.col("bit")) == 1)
    place = (F.col("at") * 8 + F.col("bit")).cast("long")
    # positive uids begin with page 1; others count down from page 0
    uid = F.when(F.col("page") > 0, (F.col("page") - 1) * PAGE_BITS + place + 1).otherwise(F.col("page") * PAGE_BITS - place)
    return bits.select(uid.alias("uid"))

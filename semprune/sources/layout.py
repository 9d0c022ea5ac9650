"""Tables of members and vectors laid out so that they join without a shuffle.

Both are written in the same number of buckets by ``idx`` and sorted in each, one file a bucket. The files can be registered
again in any session, from their folder alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 512
KEY = "idx"


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int = BUCKETS, key: str = KEY) -> DataFrame:
    """``df`` as the table ``table`` below ``path``, one file a bucket; the table."""
    spread = df.repartition(buckets, key).sortWithinPartitions(key)
    spread.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def register_bucketed(spark: SparkSession, table: str, path: str, buckets: int = BUCKETS, key: str = KEY) -> DataFrame:
    """The table of files that ``write_bucketed`` wrote, in a session that does not know it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def write_colocated(members: DataFrame, vectors: DataFrame, name: str, path: str, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Members and vectors as ``name_members`` and ``name_vectors``, joined by ``idx`` without an exchange."""
    listed = write_bucketed(members.select("cid", "ord", "idx", "uid"), f"{name}_members", f"{path}/members", buckets)
    return listed, write_bucketed(vectors.select("idx", "embedding"), f"{name}_vectors", f"{path}/vectors", buckets)


def read_colocated(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    return (
        register_bucketed(spark, f"{name}_members", f"{path}/members", buckets),
        register_bucketed(spark, f"{name}_vectors", f"{path}/vectors", buckets),
    )

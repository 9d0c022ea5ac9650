"""Reading document datasets and tables that arrive in shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from semprune.operators.checks import check_centroid_index, check_shard_kinds, check_shards, require
from semprune.operators.joins import join_counts
from semprune.operators.positions import number_rows, running_before
from semprune.sources.paths import children, exists


def number_file_rows(df: DataFrame) -> DataFrame | None:
    """Contiguous 0-based ``idx`` of the rows of a parquet scan, by (file path, row in file).

    Only row counts are read beforehand and nothing is rewritten. None when a filter has left
    gaps in the files.
    """
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = placed.groupBy("_file").agg(F.count("*").alias("_n"), (F.max("_row") + 1).alias("_end"))
    if files.where(F.col("_n") != F.col("_end")).limit(1).count():
        return None
    starts = files.select("_file", running_before("_n", [], ["_file"]).alias("_start"))
    return join_counts(placed, starts, ["_file"]).select((F.col("_start") + F.col("_row")).alias("idx"), *df.columns)


def read_documents(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    split: str | None = None,
    split_key: str = "split",
    index_key: str | None = None,
) -> DataFrame:
    """Document dataset with a stable ``idx``: the column ``index_key``, or else the position,
    counted by (file path, row in file) over the rows of the split, in every format.

    ``split`` selects one partition directory (or value) of ``split_key``.
    """
    df = spark.read.format(file_format).load(path)
    if split is not None:
        df = df.where(F.col(split_key) == split)
    if index_key is not None:
        return df.withColumn("idx", F.col(index_key).cast("long"))
    if "idx" in df.columns:
        return df
    numbered = number_file_rows(df) if file_format == "parquet" else None
    return number_rows(df) if numbered is None else numbered


def shard_of_file() -> Column:
    """Shard name of a row: the path of its file."""
    return F.col("_metadata.file_path")


def shard_of_directory() -> Column:
    """Shard name of a row: the last directory of its path."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)


def read_shards(
    spark: SparkSession, path: str, file_format: str = "parquet", by: str = "directory", table: str | None = None
) -> DataFrame:
    """All files below ``path``, with the shard every row comes from as column ``shard``.

    With ``table``, the shards are the directories directly below ``path`` that have a directory
    of this name, as the jobs write them, and only these tables are read. Where there is none, the
    files lie in the shard directories themselves.
    """
    found = [d for d in children(spark, path) if exists(spark, f"{d}/{table}")] if table else []
    reader = spark.read.format(file_format).option("recursiveFileLookup", True)
    if found:
        df = reader.load([f"{d}/{table}" for d in found])
        shard = F.regexp_extract(F.col("_metadata.file_path"), rf"([^/]+)/{table}/[^/]+$", 1)
    else:
        df = reader.load(path)
        shard = {"directory": shard_of_directory, "file": shard_of_file}[by]()
    return df.select(*[c for c in df.columns if c != "shard"], shard.alias("shard"))


def read_indexed_centroids(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Centroids and their index; one without the other, or of other centroids, fails."""
    for name in ("centroids", "index"):
        if not exists(spark, f"{path}/{name}/_SUCCESS"):
            raise FileNotFoundError(f"{path}/{name} is missing or incomplete")
    centroids, index = spark.read.parquet(f"{path}/centroids"), spark.read.parquet(f"{path}/index")
    require(check_centroid_index(centroids, index), "centroids and index do not match")
    return centroids, index


def pair_shards(vectors: DataFrame, ids: DataFrame) -> DataFrame:
    """Vectors (shard, idx, embedding) with their ids (shard, idx, uid); incomplete shards fail."""
    require(check_shards(ids, vectors), "shards of ids and vectors do not match")
    return vectors.join(ids.select("shard", "idx", "uid"), ["shard", "idx"])


def complete_shards(**kinds: DataFrame) -> None:
    """Fail unless every shard is there in every kind of table."""
    require(check_shard_kinds(**kinds), "incomplete shards")

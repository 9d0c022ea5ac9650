"""Writing results: pruned documents, clusters by subset, keep sets, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semprune.functions.names import keep_name, kept_set_name, subset_label
from semprune.operators.centroid_index import build_index
from semprune.sources.paths import delete, exists, qualified


def write_like(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    split: str | None = None,
    file_format: str = "parquet",
    compression: str | None = None,
    max_records_per_file: int | None = None,
) -> str:
    """Write the columns of the source dataset in its types, below ``path/split``."""
    target = f"{path.rstrip('/')}/{split}" if split else path
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    writer = df.select(*columns).write.format(file_format)
    if compression:
        writer = writer.option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(target)
    return target


def write_subsets(placed: DataFrame, path: str, n_subsets: int) -> None:
    """One zero-padded directory per subset, rows in order of (cid, subset_idx).

    Rows are range-partitioned by their place, so a subset that holds most rows is written
    by many tasks.
    """
    labelled = placed.withColumn("subset", subset_label(F.col("subset"), n_subsets))
    place = ["subset", "cid", "subset_idx"]
    ordered = labelled.repartitionByRange(*place).sortWithinPartitions(*place)
    ordered.write.partitionBy("subset").parquet(path)


def read_subset(spark: SparkSession, path: str, subset: int, n_subsets: int) -> DataFrame:
    """One subset; only its directory is read."""
    label = str(subset).zfill(len(str(n_subsets)))
    return spark.read.option("basePath", path).parquet(f"{path}/subset={label}")


def write_centroids(centroids: DataFrame, path: str) -> None:
    centroids.select("cid", "centroid").write.parquet(path)


def write_indexed_centroids(centroids: DataFrame, path: str) -> DataFrame:
    """``path/centroids`` and, made from what was written there, ``path/index``; the written centroids."""
    write_centroids(centroids, f"{path}/centroids")
    written = centroids.sparkSession.read.parquet(f"{path}/centroids")
    build_index(written).write.parquet(f"{path}/index")
    return written


def write_members(members: DataFrame, path: str) -> None:
    """Cluster membership, files split by ranges of (cid, ord)."""
    ordered = members.select("cid", "ord", "idx", "uid").repartitionByRange("cid", "ord").sortWithinPartitions("cid", "ord")
    ordered.write.parquet(path)


def write_flags(flags: DataFrame, fractions: list[float], path: str) -> list[str]:
    """One (uid, keep) table per fraction, e.g. ``path/keep_0pt8``."""
    targets = []
    for fraction in fractions:
        name = keep_name(fraction)
        flags.select("uid", F.col(name).alias("keep")).write.parquet(f"{path}/{name}")
        targets.append(f"{path}/{name}")
    return targets


def write_kept_set(kept: DataFrame, fraction: float, path: str) -> str:
    target = f"{path}/{kept_set_name(fraction)}"
    kept.select("uid").write.parquet(target)
    return target


def write_statistics(totals: DataFrame, by_source: DataFrame, path: str) -> None:
    """Totals (one row) and per-source rows as JSON next to the data."""
    totals.coalesce(1).write.json(f"{path}/totals")
    by_source.coalesce(1).write.json(f"{path}/sources")


def remove_inputs(spark: SparkSession, inputs: list[str], outputs: list[str]) -> None:
    """Delete merged inputs, only once every output has been committed."""
    sources = [qualified(spark, p).rstrip("/") for p in inputs]
    for output in outputs:
        if not exists(spark, f"{output}/_SUCCESS"):
            raise RuntimeError(f"{output} is not committed; inputs kept")
        if any(f"{qualified(spark, output)}/".startswith(f"{source}/") for source in sources):
            raise RuntimeError(f"{output} is below an input; inputs kept")
    for source in sources:
        delete(spark, source)

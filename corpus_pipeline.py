"""From raw documents to packed training sequences, in stages that each read what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from semprune.llm import decontaminate, line_dedup, packing, quality, simhash
from semprune.llm.common import broadcast_if_small
from semprune.session import materialize, scratch_path, ship_package


def _carried(docs: DataFrame, *names: str) -> DataFrame:
    """Each document whole in ``doc``, beside the columns that an operator reads; names that it sets do not meet those of documents."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    return rows.select("doc", *[F.col(f"doc.{n}").alias(n) for n in names if n in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, by references fitted to the documents labelled as good."""
    measured = materialize(quality.measures(_carried(docs, "doc_id", "text", "lang")).drop("text"), "measured")
    path = scratch_path(spark, "references")
    quality.write_references(quality.references(quality.trusted(measured, spark.read.parquet(f"{sf_dir}/labels.parquet"))), path)
    return quality.judge(measured, quality.read_references(spark, path)).where("kept").select("doc.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match an earlier one; a document of which no word is left goes."""
    found = materialize(line_dedup.removed_lines(docs.select("doc_id", "text")), "lines-removed")
    both = line_dedup.removed_of(docs, found).withColumn("left", line_dedup.without_lines(F.col("doc.text"), F.col("gone")))
    emptied = (F.size("gone") > 0) & ~F.col("left").rlike(r"[^\x20\x09-\x0D]")
    new = F.col("doc").withField("text", F.col("left"))
    if "n_chars" in docs.columns:
        new = new.withField("n_chars", F.length("left").cast(docs.schema["n_chars"].dataType))
    doc = F.when(F.size("gone") > 0, new).otherwise(F.col("doc"))
    return both.where(~emptied).select(doc.alias("doc")).select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints link."""
    rows = materialize(_carried(docs, "text").select("doc", "text", F.monotonically_increasing_id().alias("row")).drop("text"), "numbered")
    found = simhash.near_copies(rows.select("row", "doc.text"), "row")
    copies = materialize(found.where("id <> component").select(F.col("id").alias("row")), "near-copies")
    return rows.join(broadcast_if_small(copies, 16), "row", "left_anti").select("doc.*")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("near dedup", near_dedup),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: Tokens, fingerprints and edit distances are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, name.replace(" ", "-"))
    return docs

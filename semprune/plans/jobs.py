"""Batch jobs: each reads tables, composes operators and writes tables.

Every function takes a session, paths and plain options; ``cli`` exposes them to spark-submit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from semprune.functions.names import keep_name
from semprune.functions.vectors import is_zero_vector
from semprune.operators import checks, chunk, clusters, embed, ids, kept_pages, kmeans, merge, prune, quantiles, shards, sketches, subwords, token_states
from semprune.operators.assign import assign_nearest
from semprune.operators.centroid_index import assign_indexed
from semprune.operators.kmeans_bounds import fit_kmeans_bounded
from semprune.operators.positions import position_by_key
from semprune.operators.similarity import max_similarity, new_similarity
from semprune.operators.similarity_pruned import max_similarity_pruned
from semprune.session import materialize
from semprune.sources import matrix, sinks, tables
from semprune.sources.paths import children, exists


MODELS = embed.EMBEDDERS | {"hashed_context": token_states.HashedContext}


def _tokenizer(spark: SparkSession, name: str, vocabulary: str | None) -> chunk.Tokenizer:
    """A tokenizer by name, or subword pieces of a vocabulary file."""
    return subwords.word_pieces(spark, vocabulary) if vocabulary else chunk.TOKENIZERS[name]


def chunk_job(
    spark: SparkSession,
    documents: str,
    output: str,
    chunk_size: int = 512,
    instruction: str | None = "query: ",
    tokenizer: str = "whitespace",
    uid_key: str | None = None,
    index_key: str | None = None,
    split: str | None = None,
    file_format: str = "parquet",
    vocabulary: str | None = None,
) -> None:
    """Documents -> token chunks; with ``vocabulary``, a file of subword pieces, instead of ``tokenizer``."""
    docs = tables.read_documents(spark, documents, file_format, split, index_key=index_key)
    cut = chunk.chunk_documents(docs, chunk_size, instruction, _tokenizer(spark, tokenizer, vocabulary), uid_key)
    cut.write.parquet(output)


def embed_job(
    spark: SparkSession,
    documents: str,
    output: str,
    model: str = "hashed_words",
    dim: int = 768,
    chunk_size: int = 512,
    instruction: str | None = "query: ",
    tokenizer: str = "whitespace",
    batch_size: int = embed.MODEL_BATCH,
    uid_key: str | None = None,
    index_key: str | None = None,
    split: str | None = None,
    file_format: str = "parquet",
    vocabulary: str | None = None,
) -> DataFrame:
    """Documents -> ``output/vectors`` (idx, uid, embedding) and ``output/ids`` (idx, uid); ``vocabulary`` as for chunks.

    Returns the report on zero and broken vectors; broken ones fail the job.
    """
    docs = tables.read_documents(spark, documents, file_format, split, index_key=index_key)
    vectors = embed.embed_documents(
        docs, MODELS[model](dim), chunk_size, instruction, _tokenizer(spark, tokenizer, vocabulary), uid_key, batch_size=batch_size
    )
    vectors.write.parquet(f"{output}/vectors")
    written = spark.read.parquet(f"{output}/vectors")
    ids.id_map(written, "uid").write.parquet(f"{output}/ids")
    report = checks.check_vectors(written)
    checks.require(report, "vectors")
    return report


def _require_numbers(vectors: DataFrame) -> None:
    """Imported vectors may have any length, but every component must be a number."""
    checks.require(checks.check_vectors(vectors).withColumn("ok", F.col("n_nan") == 0), "vectors")


def merge_embeddings_job(spark: SparkSession, vectors: str, id_maps: str, output: str, delete_inputs: bool = False) -> None:
    """Shard directories of vectors and of ids -> one table with a global index."""
    paired = tables.pair_shards(
        tables.read_shards(spark, vectors, table="vectors").drop("uid"), tables.read_shards(spark, id_maps, table="ids")
    )
    shards.merge_shards(paired).select("shard", "idx", "uid", "embedding").write.parquet(output)
    _require_numbers(spark.read.parquet(output))
    if delete_inputs:
        sinks.remove_inputs(spark, [vectors, id_maps], [output])


def import_matrix_job(spark: SparkSession, path: str, output: str, dim: int | None = None, n_samples: int | None = None) -> None:
    """Raw float32 matrix file, or folder of them, -> vectors with a global index."""
    rows = shards.merge_shards(matrix.read_matrix(spark, path, n_samples, dim))
    rows.select("shard", "idx", F.col("idx").alias("uid"), "embedding").write.parquet(output)
    _require_numbers(spark.read.parquet(output))


def cluster_job(
    spark: SparkSession,
    vectors: str,
    output: str,
    n_centroids: int = 50_000,
    n_iter: int = 40,
    seed: int = kmeans.SEED,
    centroids: str | None = None,
    save_centroids: bool = True,
    train_only: bool = False,
    id_map: str | None = None,
    max_points_per_centroid: int | None = None,
    bounds: bool = True,
    saved: str | None = None,
) -> None:
    """Vectors -> ``output/centroids``, ``output/index`` and ``output/members``; given centroids are used as they are.

    ``centroids`` names a table of centroids, ``saved`` a folder with ``centroids`` and ``index``, both of which are checked and used.

    Zero vectors carry no direction and are left out of the training only. All others are trained on, unless
    ``max_points_per_centroid`` asks for a sample. With ``bounds``, rows carry bounds between iterations; the share
    of products that were computed is written to ``output/products``.
    """
    table = spark.read.parquet(vectors)
    if id_map:
        checks.require(checks.check_counts(spark.read.parquet(id_map), table), "ids and vectors")
    index = None
    if saved:
        fitted, index = tables.read_indexed_centroids(spark, saved)
        checks.require(checks.check_centroids(fitted), "centroids")
    elif centroids:
        fitted = spark.read.parquet(centroids)
        checks.require(checks.check_centroids(fitted), "centroids")
    else:
        trainable = table.where(~is_zero_vector(F.col("embedding")))
        if max_points_per_centroid:
            trainable = kmeans.train_subsample(trainable, n_centroids, max_points_per_centroid, seed)
        if bounds:
            fitted, products = fit_kmeans_bounded(trainable, n_centroids, n_iter, seed)
            products.coalesce(1).write.json(f"{output}/products")
        else:
            fitted = kmeans.fit_kmeans(trainable, n_centroids, n_iter, seed)
        if save_centroids:
            fitted = sinks.write_indexed_centroids(fitted, output)
            index = spark.read.parquet(f"{output}/index")
    if train_only:
        return
    rows = table.select("idx", "uid", "embedding")
    assigned = materialize(assign_indexed(rows, fitted, index) if index else assign_nearest(rows, fitted), "assigned")
    members = clusters.order_members(assigned)
    if id_map:
        members = clusters.attach_uids(members, spark.read.parquet(id_map))
    sinks.write_members(members, f"{output}/members")
    clusters.cluster_sizes(fitted, assigned).coalesce(1).write.parquet(f"{output}/sizes")


def merge_clusters_job(spark: SparkSession, members: str, output: str, sizes: str | None = None, delete_inputs: bool = False) -> None:
    """Shard directories of members -> one membership table, cluster by cluster in shard order."""
    rows = tables.read_shards(spark, members, table="members")
    written = any(exists(spark, f"{d}/sizes") for d in children(spark, members))
    listed = tables.read_shards(spark, sizes or members, table="sizes") if sizes or written else rows
    checks.require(checks.check_cluster_counts(listed), "numbers of clusters differ")
    shards.merge_member_lists(rows).select("cid", "ord", "shard", "idx", "uid").write.parquet(output)
    if delete_inputs:
        sinks.remove_inputs(spark, [members], [output])


def regroup_job(spark: SparkSession, members: str, vectors: str, output: str, n_clusters: int, n_subsets: int = 200) -> None:
    """Members and shards of vectors -> ``output/subset=…`` with an index inside the subset.

    Order inside a cluster is (shard, ord); members without a vector are skipped.
    """
    stored = tables.read_shards(spark, vectors, table="vectors")
    listed = spark.read.parquet(members)
    joined = materialize(shards.select_members(listed.select("cid", "ord", "uid"), stored.select("shard", "uid")), "joined")
    checks.require(checks.check_unique(stored, "uid"), "uids in several shards")
    ranked = position_by_key(joined, ["shard", "cid"], "ord", "rank")
    placed = shards.subset_positions(ranked, n_clusters, n_subsets)
    rows = placed.select("subset", "shard", "cid", "pos", "subset_idx", "uid").join(stored.select("uid", "embedding"), "uid")
    sinks.write_subsets(rows, output, n_subsets)


def similarity_job(
    spark: SparkSession,
    members: str,
    vectors: str,
    output: str,
    points: list[float] | None = None,
    subsample: int = -1,
    tile_rows: int | None = None,
    earlier_members: str | None = None,
    prune_tiles: bool = False,
) -> None:
    """Members and vectors -> ``output/similarity`` (cid, ord, idx, uid, sim) and ``output/quantiles``.

    With ``earlier_members``, whose scores are known, ``members`` are new ones behind them in their clusters, ``vectors`` holds those of
    both, and only new members are scored. ``prune_tiles`` rules out tiles of large clusters by bounds; scores are the same.
    """
    listed = clusters.first_clusters(spark.read.parquet(members), subsample)
    table = spark.read.parquet(vectors)
    if earlier_members:
        scores = new_similarity(spark.read.parquet(earlier_members), listed, table, tile_rows)
    else:
        scores = (max_similarity_pruned if prune_tiles else max_similarity)(listed, table, tile_rows)
    scores.write.parquet(f"{output}/similarity")
    written = spark.read.parquet(f"{output}/similarity")
    checks.require(checks.check_similarity_labels(listed, written), "similarities per label")
    quantiles.quantiles(written, points).coalesce(1).write.parquet(f"{output}/quantiles")
    sketches.sketches(written).coalesce(1).write.parquet(f"{output}/sketch")


def merge_similarity_job(
    spark: SparkSession,
    scores: str,
    output: str,
    points: list[float] | None = None,
    rule: str = "last",
    exact: bool = True,
    delete_inputs: bool = False,
    sketch: bool = False,
) -> None:
    """Shard directories of scores -> one score per uid and quantiles, exact or merged by shard size.

    With ``sketch``, quantiles come from the sketches stored with the shards, with the scores between which exact ones lie.
    """
    rows = tables.read_shards(spark, scores, table="similarity")
    merge.resolve_duplicates(rows, rule).write.parquet(f"{output}/similarity")
    if sketch:
        table = sketches.sketch_quantiles(sketches.merge_sketches(tables.read_shards(spark, scores, table="sketch")), points)
    else:
        table = quantiles.quantiles(rows, points) if exact else quantiles.merge_quantiles(quantiles.shard_quantiles(rows, points))
    table.coalesce(1).write.parquet(f"{output}/quantiles")
    if delete_inputs:
        sinks.remove_inputs(spark, [scores], [f"{output}/similarity", f"{output}/quantiles"])


def merge_threshold_job(
    spark: SparkSession, scores: str, output: str, keep: float, exact: bool = True, delete_inputs: bool = False
) -> None:
    """Shard directories of scores -> the set of uids below the threshold in any shard, with counts."""
    rows = tables.read_shards(spark, scores, table="similarity")
    table = quantiles.quantiles(rows) if exact else quantiles.merge_quantiles(quantiles.shard_quantiles(rows))
    table = materialize(table.coalesce(1), "quantiles")
    threshold = quantiles.threshold_at(table, keep)
    target = sinks.write_kept_set(merge.kept_set(rows, threshold), keep, output)
    if rows.schema["uid"].dataType.typeName() in ("byte", "short", "integer", "long"):
        kept_pages.kept_pages(rows, threshold).write.parquet(f"{output}/pages")
    table.write.parquet(f"{output}/quantiles")
    merge.kept_counts(rows, threshold).coalesce(1).write.json(f"{output}/counts")
    if delete_inputs:
        sinks.remove_inputs(spark, [scores], [target, f"{output}/quantiles", f"{output}/counts"])


def flags_job(spark: SparkSession, scores: str, output: str, keep: list[float]) -> list[str]:
    """Scores with quantiles -> one (uid, keep) table per fraction, and the quantiles beside them.

    Unknown fractions fail first. ``prune_job`` takes the output in place of scores.
    """
    table = spark.read.parquet(f"{scores}/quantiles")
    quantiles.thresholds_at(table, keep)
    table.coalesce(1).write.parquet(f"{output}/quantiles")
    flags = prune.keep_flags(spark.read.parquet(f"{scores}/similarity"), table, keep)
    return sinks.write_flags(flags, keep, output)


def invert_ids_job(spark: SparkSession, id_map: str, output: str) -> None:
    ids.invert_ids(spark.read.parquet(id_map)).write.parquet(output)


def prune_job(
    spark: SparkSession,
    documents: str,
    scores: str,
    output: str,
    keep: float,
    source_key: str | None = "source",
    split: str | None = None,
    uid_key: str | None = None,
    index_key: str | None = None,
    kept_set: str | None = None,
    file_format: str = "parquet",
    compression: str | None = None,
    max_records_per_file: int | None = None,
    rule: str = "last",
    flags: bool = False,
) -> str:
    """Documents and scores -> pruned documents below ``output/split`` and statistics.

    ``scores`` holds ``quantiles`` and ``similarity`` (numbers, text or flags), or with ``flags`` what
    ``flags_job`` wrote; with ``kept_set`` the documents of that set are kept instead. A uid with
    several scores has one by ``rule``: ``last`` by (shard, cid, ord), ``max``, or ``error``.
    """
    docs = tables.read_documents(spark, documents, file_format, split, index_key=index_key)
    source = spark.read.format(file_format).load(documents).schema
    write = lambda df: sinks.write_like(df, output, source, split, file_format, compression, max_records_per_file)
    if kept_set:
        uids = spark.read.parquet(kept_set).select("uid").distinct()
        keeps = uids.withColumn("keep", F.lit(True))
        target = write(prune.prune_documents(docs, keeps, uid_key))
        judged = materialize(prune.judge(docs, keeps, uid_key, source_key), "judged")
        sinks.write_statistics(prune.set_totals(docs, uids, uid_key), prune.source_totals(judged), f"{output}/statistics")
        return target
    threshold = quantiles.threshold_at(spark.read.parquet(f"{scores}/quantiles"), keep)
    if flags:
        similarity = spark.read.parquet(f"{scores}/{keep_name(keep)}").withColumnRenamed("keep", "sim")
    else:
        similarity = spark.read.parquet(f"{scores}/similarity")
    keeps = materialize(prune.keep_map(merge.resolve_duplicates(similarity, rule), threshold), "keeps")
    pruned = prune.ObservedPrune(docs, keeps, uid_key, source_key)
    target = write(pruned.kept)
    by_source = pruned.source_totals()
    if by_source is None:
        by_source = prune.source_totals(prune.judge(docs, keeps, uid_key, source_key))
    sinks.write_statistics(pruned.totals(), by_source, f"{output}/statistics")
    return target

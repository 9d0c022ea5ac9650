"""

Inputs: ``embeddings`` (vec_id is both index and uid, ``label`` a given cluster id) and
``documents`` (doc_id joins vec_id). Where a query needs centroids they are the unit-length
means of the labels; where it needs shards, ``vec_id % 4`` names the shard of a row.
"""

from __future__ import annotations

import importlib.util
import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle
from semprune.functions.names import kept_set_name
from semprune.functions.text import whitespace_tokens
from semprune.functions.vectors import is_zero_vector, l2_normalize
from semprune.operators import checks, chunk, clusters, embed, ids, kept_pages, kmeans, merge, prune, quantiles, shards, sketches, subwords, token_states
from semprune.operators.assign import assign_nearest
from semprune.operators.centroid_index import assign_indexed
from semprune.operators.kmeans_bounds import fit_kmeans_bounded
from semprune.operators.positions import position_by_key, position_by_order
from semprune.operators.similarity import max_similarity, new_similarity
from semprune.operators.similarity_pruned import max_similarity_pruned
from semprune.plans import jobs
from semprune.session import materialize, scratch_path, ship_package
from semprune.sources import layout, matrix, sinks, tables

#: The corpus operators are an optional part; what else is here works without them.
WITH_LLM = importlib.util.find_spec("semprune.llm") is not None
if WITH_LLM:
    import corpus_pipeline
    from semprune.llm import queries as llm_queries

SMOKE_DIR = "/root/testdata/sf0.001"
KEEP = 0.8
N_SHARDS = 4
N_SUBSETS = 4
N_BUCKETS = 8
CHUNK_SIZE = 126
INSTRUCTION = "query: "
VOCABULARY = "piece_bpe_32k.model"
DIM = 64
#: Bytes of the texts of a file that a query writes.
FILE_BYTES = 64 << 20


def _digits(column, n: int = 6):
    return F.round(column, n)


# --- inputs -------------------------------------------------------------------------------


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return df.select(F.col("vec_id").alias("idx"), F.col("vec_id").alias("uid"), "embedding", F.col("label").alias("cid"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("idx", F.col("doc_id"))


def _centroids(vectors: DataFrame) -> DataFrame:
    return materialize(kmeans.cluster_means(vectors.select("cid", "embedding")).select("cid", "centroid"), "centroids")


def _labelled(vectors: DataFrame) -> DataFrame:
    """Members of the given clusters."""
    return clusters.order_members(vectors)


def _nearest(vectors: DataFrame) -> DataFrame:
    """Members of the clusters of the label means."""
    assigned = assign_nearest(vectors.select("idx", "uid", "embedding"), _centroids(vectors))
    return clusters.order_members(materialize(assigned, "assigned"))


def _label_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    return materialize(max_similarity(_labelled(vectors), vectors), "scores")


def _shard_name(column):
    return F.concat(F.lit("shard_"), (column % N_SHARDS).cast("string"))


def _shard_rows(vectors: DataFrame) -> DataFrame:
    """(shard, idx, uid, cid, embedding) with the index local to the shard."""
    narrow = vectors.select(_shard_name(F.col("uid")).alias("shard"), "uid", "cid")
    local = position_by_key(narrow, ["shard"], "uid", "idx")
    return local.join(vectors.select("uid", "embedding"), "uid")


def _shard_members(vectors: DataFrame) -> DataFrame:
    """(shard, cid, rank, uid) with the rank local to (shard, cluster)."""
    narrow = vectors.select(_shard_name(F.col("uid")).alias("shard"), "cid", "uid")
    return position_by_key(narrow, ["shard", "cid"], "uid", "rank")


def _sharded_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two score files over the same uids: given clusters and nearest-centroid clusters."""
    vectors = _vectors(spark, sf_dir)
    by_label = max_similarity(_labelled(vectors), vectors).withColumn("shard", F.lit("a_label"))
    by_nearest = max_similarity(_nearest(vectors), vectors).withColumn("shard", F.lit("b_nearest"))
    return materialize(by_label.unionByName(by_nearest).select("shard", "uid", "ord", "sim"), "sharded-scores")


def _keeps(scores: DataFrame) -> DataFrame:
    threshold = quantiles.threshold_at(quantiles.quantiles(scores, [KEEP]), KEEP)
    return prune.keep_map(scores, threshold)


def _kept_uids(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _sharded_scores(spark, sf_dir)
    merged = quantiles.merge_quantiles(quantiles.shard_quantiles(scores, [KEEP]))
    return merge.kept_set(scores, quantiles.threshold_at(merged, KEEP))


# --- vectors and clusters -------------------------------------------------------------------


def q_l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("cid") + 1))
    unit = _vectors(spark, sf_dir).select("uid", F.posexplode(l2_normalize(scaled)).alias("pos", "value"))
    return unit.select("uid", "pos", _digits("value").alias("value"))


def q_zero_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    return vectors.groupBy("cid").agg(
        F.count("*").alias("n"), F.count_if(is_zero_vector(F.col("embedding"))).alias("n_zero")
    )


def q_assign_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    assigned = assign_nearest(vectors.select("uid", "embedding"), _centroids(vectors))
    return assigned.select("uid", "cid", _digits("centroid_sim").alias("centroid_sim"))


def q_assign_nearest_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for centroids beyond the broadcast limit."""
    vectors = _vectors(spark, sf_dir)
    assigned = assign_nearest(vectors.select("uid", "embedding"), _centroids(vectors), ["uid"], 4 * 8 * DIM)
    return assigned.select("uid", "cid", _digits("centroid_sim").alias("centroid_sim"))


def q_assign_nearest_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same plan where the kept column names many rows at once."""
    vectors = _vectors(spark, sf_dir)
    rows = vectors.select((F.col("uid") % 5).alias("uid"), "embedding")
    assigned = assign_nearest(rows, _centroids(vectors), ["uid"], 4 * 8 * DIM)
    return assigned.select("uid", "cid", _digits("centroid_sim").alias("centroid_sim"))


def q_assign_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centroids and their index written, read together and searched."""
    vectors = _vectors(spark, sf_dir)
    path = scratch_path(spark, "indexed-centroids")
    sinks.write_indexed_centroids(_centroids(vectors), path)
    found = assign_indexed(vectors.select("uid", "embedding"), *tables.read_indexed_centroids(spark, path))
    return found.select("uid", "cid", _digits("centroid_sim").alias("centroid_sim"))


def q_cluster_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(_vectors(spark, sf_dir))


def q_cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the given clusters and of five clusters nobody is in."""
    vectors = _vectors(spark, sf_dir)
    known = vectors.select("cid").distinct()
    centroids = known.unionByName(known.select((F.col("cid") + 5).alias("cid"))).distinct()
    return clusters.cluster_sizes(centroids, vectors)


def q_cluster_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested membership, lists shown as text."""
    vectors = _vectors(spark, sf_dir)
    lists = clusters.member_lists(vectors.select("cid").distinct(), _labelled(vectors), page_rows=16)
    return lists.select(
        "cid",
        "page",
        F.array_join(F.col("inds").cast("array<string>"), ",").alias("inds"),
        F.array_join(F.col("labels").cast("array<string>"), ",").alias("labels"),
    )


def q_member_uids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    named = ids.id_map(vectors.withColumn("name", F.concat(F.lit("doc-"), F.col("uid").cast("string"))), "name")
    return clusters.attach_uids(_labelled(vectors), named).select("cid", "ord", "idx", "uid")


def q_rank_in_cluster_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    ranked = clusters.rank_in_cluster(vectors, _centroids(vectors), "cosine", keep_hard=True)
    return ranked.select("cid", "uid", _digits("distance").alias("distance"), "rank")


def q_rank_in_cluster_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    ranked = clusters.rank_in_cluster(vectors, _centroids(vectors), "l2", keep_hard=False)
    return ranked.select("cid", "uid", _digits("distance").alias("distance"), "rank")


def q_lloyd_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One k-means iteration from the label means."""
    vectors = _vectors(spark, sf_dir)
    moved = kmeans.lloyd_step(vectors.select("idx", "embedding"), _centroids(vectors))
    return moved.select("cid", F.posexplode("centroid").alias("pos", "value")).select(
        "cid", "pos", _digits("value").alias("value")
    )


def q_train_subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans.train_subsample(_vectors(spark, sf_dir), 10, max_points_per_centroid=16).select("uid")


def q_kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    fitted = kmeans.fit_kmeans(vectors, k=10, n_iter=5)
    return fitted.select("cid", F.posexplode("centroid").alias("pos", "value")).select(
        "cid", "pos", _digits(F.col("value").cast("double"), 5).alias("value")
    )


def q_kmeans_fit_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same centroids with bounds carried between iterations."""
    fitted, _ = fit_kmeans_bounded(_vectors(spark, sf_dir), k=10, n_iter=5)
    return fitted.select("cid", F.posexplode("centroid").alias("pos", "value")).select(
        "cid", "pos", _digits(F.col("value").cast("double"), 5).alias("value")
    )


def q_kmeans_fit_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector three times, with components shifted by turns: far more rows than centroids."""
    vectors = _vectors(spark, sf_dir)
    copy = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("copy")
    rows = vectors.select("idx", "embedding", copy)
    shifted = F.transform("embedding", lambda x, i: x.cast("double") * (1 + F.when(i % 3 == F.col("copy"), 0.5).otherwise(0.0)))
    rows = rows.select((F.col("idx") * 3 + F.col("copy")).alias("idx"), shifted.cast("array<float>").alias("embedding"))
    fitted = kmeans.fit_kmeans(rows, k=4, n_iter=4)
    return fitted.select("cid", F.posexplode("centroid").alias("pos", "value")).select(
        "cid", "pos", _digits(F.col("value").cast("double"), 5).alias("value")
    )


def q_kmeans_assign_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centroids written and read back instead of trained."""
    vectors = _vectors(spark, sf_dir)
    path = scratch_path(spark, "saved-centroids")
    sinks.write_centroids(_centroids(vectors), path)
    saved = spark.read.parquet(path)
    checks.require(checks.check_centroids(saved), "saved centroids")
    assigned = assign_nearest(vectors.select("uid", "embedding"), saved)
    return assigned.groupBy("cid").agg(F.count("*").alias("n"))


# --- similarity, quantiles, pruning -----------------------------------------------------------


def q_max_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    scores = max_similarity(_labelled(vectors), vectors)
    return scores.select("cid", "ord", "uid", _digits("sim").alias("sim"))


def q_max_similarity_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scores from small tiles, as for a cluster far above the tile size."""
    vectors = _vectors(spark, sf_dir)
    scores = max_similarity(_labelled(vectors), vectors, tile_rows=16)
    return scores.select("cid", "ord", "uid", _digits("sim").alias("sim"))


def q_max_similarity_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector three times."""
    vectors = _vectors(spark, sf_dir)
    copy = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("copy")
    tripled = vectors.select((F.col("idx") * 3).alias("base"), copy, "embedding", "cid")
    tripled = tripled.select((F.col("base") + F.col("copy")).alias("idx"), "embedding", "cid").withColumn("uid", F.col("idx"))
    scores = max_similarity(_labelled(tripled), tripled, hot_copies=2)
    return scores.select("cid", "ord", "uid", _digits("sim").alias("sim"))


def q_max_similarity_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of lengths 0 to 6, three times each, in clusters of many: a later copy may be nearer to one between."""
    vectors = _vectors(spark, sf_dir)
    copy = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("copy")
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("idx") % 7))
    rows = vectors.select("idx", copy, scaled.cast("array<float>").alias("embedding"), (F.col("cid") % 3).alias("cid"))
    # From 100,000 rows on, copies of different vectors share a uid, so the index counts the copy too; the order is that of the uid.
    uid = F.col("idx") + F.col("copy") * 100_000
    rows = rows.select((uid * 3 + F.col("copy")).alias("idx"), uid.alias("uid"), "embedding", "cid")
    scores = max_similarity(_labelled(rows), rows, tile_rows=32)
    return scores.select("cid", "ord", "uid", _digits("sim").alias("sim"))


def q_max_similarity_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members and vectors from tables that join without a shuffle."""
    vectors = _vectors(spark, sf_dir)
    name = f"scores_{uuid.uuid4().hex}"
    members, stored = layout.write_colocated(_labelled(vectors), vectors, name, scratch_path(spark, "colocated"), N_BUCKETS)
    return max_similarity(members, stored).select("cid", "ord", "uid", _digits("sim").alias("sim"))


def q_max_similarity_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scores with tiles of neighbours, most of which bounds rule out."""
    vectors = _vectors(spark, sf_dir)
    scores = max_similarity_pruned(_labelled(vectors), vectors, tile_rows=16)
    return scores.select("cid", "ord", "uid", _digits("sim").alias("sim"))


def q_max_similarity_by_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard after shard, each scored against the members before it, with every vector once more in the last shard."""
    vectors = _vectors(spark, sf_dir)
    again = F.explode(F.array(F.lit(0), F.lit(1))).alias("again")
    rows = vectors.select("idx", "cid", "embedding", again)
    shard = F.when(F.col("again") == 0, F.col("idx") % N_SHARDS).otherwise(N_SHARDS).cast("int")
    rows = rows.select((F.col("idx") * 2 + F.col("again")).alias("idx"), "cid", "embedding", shard.alias("shard")).withColumn("uid", F.col("idx"))
    rows = materialize(rows, "rows-by-shard")
    order = [F.col("shard"), F.col("uid")]
    members = materialize(position_by_order(rows.select("cid", "shard", "idx", "uid"), ["cid"], order, "ord"), "members-by-shard")
    scores = max_similarity(members.where("shard = 0"), rows)
    for k in range(1, N_SHARDS + 1):
        scores = scores.unionByName(new_similarity(members.where(F.col("shard") < k), members.where(F.col("shard") == k), rows))
    return scores.select("cid", "ord", "uid", _digits("sim").alias("sim"))


def q_similarity_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimate from the first clusters only (the sampling feature of the similarity job)."""
    vectors = _vectors(spark, sf_dir)
    scores = max_similarity(clusters.first_clusters(_labelled(vectors), 5), vectors)
    return scores.select("cid", "ord", "uid", _digits("sim").alias("sim"))


def q_similarity_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = quantiles.quantiles(_label_scores(spark, sf_dir))
    return table.select("q", _digits("value").alias("value"))


def q_quantiles_of_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector three times: two thirds of the scores lie within rounding of 1."""
    vectors = _vectors(spark, sf_dir)
    copy = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("copy")
    rows = vectors.select("idx", copy, "embedding", "cid").withColumn("idx", F.col("idx") * 3 + F.col("copy")).withColumn("uid", F.col("idx"))
    scores = materialize(max_similarity(_labelled(rows), rows), "scores")
    return quantiles.quantiles(scores).select("q", _digits("value").alias("value"))


def q_quantiles_of_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of a column far outside [0, 1]."""
    lengths = _documents(spark, sf_dir).select(F.col("n_chars").cast("double").alias("n_chars"))
    return quantiles.quantiles(lengths, column="n_chars").select("q", _digits("value").alias("value"))


def q_keep_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _label_scores(spark, sf_dir)
    return prune.keep_flags(scores, quantiles.quantiles(scores), [0.25, 0.5, 0.8])


def q_prune_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = prune.prune_documents(_documents(spark, sf_dir), _keeps(_label_scores(spark, sf_dir)), "doc_id")
    return kept.select("doc_id", "text", "lang", "source", "n_chars")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prune.judge(_documents(spark, sf_dir), _keeps(_label_scores(spark, sf_dir)), "doc_id", "source")


def q_prune_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = prune.totals(_judged(spark, sf_dir))
    return totals.withColumn("mean_length", _digits("mean_length"))


def q_prune_stats_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prune.source_totals(_judged(spark, sf_dir)).withColumn("mean_length", _digits("mean_length"))


def q_prune_stats_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals that a pruning job observes while it writes, read back."""
    root = scratch_path(spark, "observed")
    scores = _label_scores(spark, sf_dir)
    scores.write.parquet(f"{root}/scores/similarity")
    quantiles.quantiles(scores).write.parquet(f"{root}/scores/quantiles")
    jobs.prune_job(spark, f"{sf_dir}/documents.parquet", f"{root}/scores", f"{root}/out", KEEP, uid_key="doc_id", index_key="doc_id")
    names = "n_samples long, mean_length double, found long, not_found long, no_uid long, removed long"
    return spark.read.schema(names).json(f"{root}/out/statistics/totals").withColumn("mean_length", _digits("mean_length"))


def q_prune_not_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a similarity."""
    return _judged(spark, sf_dir).where(F.col("status") == "not_found").select(F.col("uid").alias("doc_id"), "source")


def q_prune_text_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarities stored as text, some of them no number: those documents count as not found."""
    scores = _label_scores(spark, sf_dir)
    threshold = quantiles.threshold_at(quantiles.quantiles(scores, [KEEP]), KEEP)
    text = F.when(F.col("ord") == 0, F.lit("n/a")).otherwise(F.col("sim").cast("string"))
    stored = scores.select("uid", text.alias("sim"))
    judged = prune.judge(_documents(spark, sf_dir), prune.keep_map(stored, threshold), "doc_id")
    return judged.groupBy("status").agg(F.count("*").alias("n"))


def q_prune_kept_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = prune.prune_to_set(_documents(spark, sf_dir), _kept_uids(spark, sf_dir), "doc_id")
    return kept.select("doc_id", "source", "n_chars")


def q_prune_outside_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    outside = prune.outside_set(_documents(spark, sf_dir), _kept_uids(spark, sf_dir), "doc_id")
    return outside.select("doc_id", "source", "n_chars")


def q_prune_string_uids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as uids: looked up narrowly, the texts stay where they are."""
    name = lambda c: F.concat(F.lit("doc-"), F.col(c).cast("string"))
    docs = _documents(spark, sf_dir).withColumn("name", name("doc_id"))
    keeps = _keeps(_label_scores(spark, sf_dir)).withColumn("uid", name("uid"))
    return prune.prune_documents(docs, keeps, "name").select("doc_id", "source", "n_chars")


def q_prune_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores to flags to pruned documents, through the jobs."""
    root = scratch_path(spark, "flag-pruning")
    scores = _label_scores(spark, sf_dir)
    scores.write.parquet(f"{root}/scores/similarity")
    quantiles.quantiles(scores).write.parquet(f"{root}/scores/quantiles")
    jobs.flags_job(spark, f"{root}/scores", f"{root}/flags", [0.5, KEEP])
    target = jobs.prune_job(
        spark, f"{sf_dir}/documents.parquet", f"{root}/flags", f"{root}/out", KEEP, uid_key="doc_id", index_key="doc_id", flags=True
    )
    return spark.read.parquet(target).select("doc_id", "source", "n_chars")


def q_prune_repeated_uids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as uids: each has many scores, of which the last by (cluster, position) counts."""
    scores = _label_scores(spark, sf_dir)
    threshold = quantiles.threshold_at(quantiles.quantiles(scores, [KEEP]), KEEP)
    named = scores.withColumn("uid", F.concat(F.lit("src"), (F.col("uid") % 20).cast("string")))
    keeps = prune.keep_map(merge.resolve_duplicates(named, "last"), threshold)
    return prune.prune_documents(_documents(spark, sf_dir), keeps, "source").select("doc_id", "source", "n_chars")


def q_read_documents_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in JSON files, numbered by (file, row) after a filter."""
    path = scratch_path(spark, "json-documents")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    docs.repartitionByRange(max(3, -(-n_bytes // FILE_BYTES)), "doc_id").sortWithinPartitions("doc_id").write.json(path)
    return tables.read_documents(spark, path, "json", split="en", split_key="lang").select("idx", "doc_id", F.length("text").alias("length"))


def q_prune_set_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = prune.set_totals(_documents(spark, sf_dir), _kept_uids(spark, sf_dir), "doc_id")
    return totals.withColumn("mean_length", _digits("mean_length"))


def q_write_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pruned documents written with the schema of the source and read back from their split."""
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = prune.prune_documents(_documents(spark, sf_dir), _keeps(_label_scores(spark, sf_dir)), "doc_id")
    path = scratch_path(spark, "pruned")
    target = sinks.write_like(kept, path, source.schema, split="train", compression="zstd", max_records_per_file=5000)
    return spark.read.parquet(target)


# --- shards -------------------------------------------------------------------------------------


def q_shard_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_offsets(_vectors(spark, sf_dir).select(_shard_name(F.col("uid")).alias("shard")))


def q_merge_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of vectors and ids paired, checked and put behind each other."""
    rows = _shard_rows(_vectors(spark, sf_dir))
    paired = tables.pair_shards(rows.select("shard", "idx", "embedding"), rows.select("shard", "idx", "uid"))
    merged = shards.merge_shards(paired)
    return merged.select("shard", "idx", "uid", _digits(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x)).alias("total"))


def q_merge_cluster_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = _shard_members(_vectors(spark, sf_dir)).withColumnRenamed("rank", "ord")
    return shards.merge_member_lists(members).select("cid", "ord", "shard", "uid")


def q_cluster_subsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subsets of the member positions taken as cluster ids, so that N grows with the table."""
    vectors = _vectors(spark, sf_dir)
    numbered = position_by_key(vectors.select("uid"), [], "uid", "cid").select("cid")
    return shards.cluster_subsets(numbered, numbered.count(), 49)


def q_select_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members joined with the shard vectors by uid; members are documents, some without a vector."""
    members = _documents(spark, sf_dir).select(F.col("doc_id").alias("uid"), "source")
    joined = shards.select_members(members, _shard_rows(_vectors(spark, sf_dir)))
    return joined.select("shard", "cid", "idx", "uid", "source")


def q_subset_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = _shard_members(_vectors(spark, sf_dir))
    return shards.subset_positions(members, 10, N_SUBSETS).select("subset", "shard", "cid", "uid", "pos")


def q_regroup_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regrouped vectors written by subset and read back, with their merged index."""
    vectors = _vectors(spark, sf_dir)
    placed = shards.subset_positions(_shard_members(vectors), 10, N_SUBSETS)
    path = scratch_path(spark, "subsets")
    sinks.write_subsets(placed.join(vectors.select("uid", "embedding"), "uid"), path, N_SUBSETS)
    return spark.read.parquet(path).select(F.col("subset").cast("int").alias("subset"), "cid", "subset_idx", "uid")


def q_subset_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.subset_sizes(_shard_members(_vectors(spark, sf_dir)), 10, N_SUBSETS)


def q_subset_shard_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.subset_shard_offsets(_shard_members(_vectors(spark, sf_dir)), 10, N_SUBSETS)


def q_read_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score files of several shards found by a recursive scan."""
    scores = _sharded_scores(spark, sf_dir)
    path = scratch_path(spark, "score-files")
    scores.withColumnRenamed("shard", "file").write.partitionBy("file").parquet(path)
    found = tables.read_shards(spark, path)
    return found.groupBy(F.regexp_replace("shard", "^file=", "").alias("shard")).agg(
        F.count("*").alias("n"), _digits(F.sum("sim"), 4).alias("total")
    )


def q_read_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors written as raw float32 matrix files and read back with their global index."""
    vectors = _vectors(spark, sf_dir)
    path = scratch_path(spark, "matrix")
    matrix.write_matrix(vectors, path)
    merged = shards.merge_shards(matrix.read_matrix(spark, path, dim=DIM))
    return merged.select("idx", F.posexplode("embedding").alias("pos", "value")).select(
        "idx", "pos", _digits(F.col("value").cast("double")).alias("value")
    )


# --- merged results -------------------------------------------------------------------------------


def q_merged_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = quantiles.merge_quantiles(quantiles.shard_quantiles(_sharded_scores(spark, sf_dir)))
    return table.select("q", _digits("value").alias("value"))


def q_merged_quantiles_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles over the union of all shards."""
    table = quantiles.quantiles(_sharded_scores(spark, sf_dir))
    return table.select("q", _digits("value").alias("value"))


def q_merge_similarities_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_similarities(_sharded_scores(spark, sf_dir)).select("uid", _digits("sim").alias("sim"))


def q_merge_similarities_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.resolve_duplicates(_sharded_scores(spark, sf_dir), "max").select("uid", _digits("sim").alias("sim"))


def q_merge_threshold_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_uids(spark, sf_dir)


def q_merge_threshold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _sharded_scores(spark, sf_dir)
    merged = quantiles.merge_quantiles(quantiles.shard_quantiles(scores, [KEEP]))
    counts = merge.kept_counts(scores, quantiles.threshold_at(merged, KEEP))
    return counts.withColumn("kept_share", _digits("kept_share"))


def q_sketch_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles, and whether they lie between the bounds that the merged sketches of the shards give."""
    scores = _sharded_scores(spark, sf_dir)
    stored = materialize(sketches.sketches(scores, ["shard"]), "sketches")
    found = sketches.sketch_quantiles(sketches.merge_sketches(stored))
    both = quantiles.quantiles(scores).join(found.select("q", "low", "high"), "q")
    return both.select("q", _digits("value").alias("value"), F.col("value").between(F.col("low"), F.col("high")).alias("within"))


def _kept_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _sharded_scores(spark, sf_dir)
    merged = quantiles.merge_quantiles(quantiles.shard_quantiles(scores, [KEEP]))
    return materialize(kept_pages.kept_pages(scores, quantiles.threshold_at(merged, KEEP)), "kept-pages")


def q_kept_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged kept set, from the stored bits of the shards."""
    return kept_pages.page_uids(kept_pages.merged_pages(_kept_pages(spark, sf_dir)))


def q_kept_pages_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_pages.page_counts(_kept_pages(spark, sf_dir)).withColumn("kept_share", _digits("kept_share"))


def q_prune_to_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = kept_pages.merged_pages(_kept_pages(spark, sf_dir))
    return prune.prune_to_pages(_documents(spark, sf_dir), pages, "doc_id").select("doc_id", "source", "n_chars")


def q_sharded_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two shards through the jobs: clusters, their merged lists, similarities, their merged scores."""
    vectors = _vectors(spark, sf_dir)
    root = scratch_path(spark, "sharded")
    sinks.write_centroids(_centroids(vectors), f"{root}/centroids")
    for shard in (0, 1):
        vectors.where(F.col("uid") % 2 == shard).select("idx", "uid", "embedding").write.parquet(f"{root}/vectors/{shard}")
        jobs.cluster_job(spark, f"{root}/vectors/{shard}", f"{root}/clusters/{shard}", centroids=f"{root}/centroids")
        jobs.similarity_job(spark, f"{root}/clusters/{shard}/members", f"{root}/vectors/{shard}", f"{root}/scores/{shard}")
    jobs.merge_clusters_job(spark, f"{root}/clusters", f"{root}/members")
    jobs.merge_similarity_job(spark, f"{root}/scores", f"{root}/merged", delete_inputs=True)
    merged = spark.read.parquet(f"{root}/merged/similarity").select("uid", _digits("sim").alias("sim"))
    return spark.read.parquet(f"{root}/members").select("cid", "ord", "uid").join(merged, "uid")


# --- jobs: run, and what they wrote read back ---------------------------------------------------------


def q_job_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "job-chunks")
    jobs.chunk_job(spark, f"{sf_dir}/documents.parquet", out, CHUNK_SIZE, INSTRUCTION, uid_key="doc_id", index_key="doc_id")
    return _chunk_rows(spark.read.parquet(out))


def q_job_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors and their ids, joined by the index both were written with."""
    out = scratch_path(spark, "job-vectors")
    jobs.embed_job(spark, f"{sf_dir}/documents.parquet", out, dim=DIM, chunk_size=CHUNK_SIZE, instruction=None, uid_key="doc_id", index_key="doc_id")
    vectors = spark.read.parquet(f"{out}/vectors").drop("uid")
    return _components(vectors.join(spark.read.parquet(f"{out}/ids"), "idx"), "uid", "n_chunks", digits=5)


def q_job_merge_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "job-shards")
    rows = _shard_rows(_vectors(spark, sf_dir)).withColumnRenamed("shard", "file")
    for shard in range(N_SHARDS):
        mine = materialize(rows.where(F.col("file") == f"shard_{shard}").drop("file"), "shard-rows")
        mine.select("idx", "uid", "embedding").write.parquet(f"{root}/in/shard_{shard}/vectors")
        mine.select("idx", "uid").write.parquet(f"{root}/in/shard_{shard}/ids")
    jobs.merge_embeddings_job(spark, f"{root}/in", f"{root}/in", f"{root}/merged")
    merged = spark.read.parquet(f"{root}/merged")
    return merged.select("shard", "idx", "uid", _digits(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x)).alias("total"))


def q_job_regroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "job-subsets")
    vectors = _vectors(spark, sf_dir)
    _labelled(vectors).write.parquet(f"{root}/members")
    vectors.select("uid", "embedding", _shard_name(F.col("uid")).alias("shard")).write.partitionBy("shard").parquet(f"{root}/vectors")
    jobs.regroup_job(spark, f"{root}/members", f"{root}/vectors", f"{root}/subsets", n_clusters=10, n_subsets=N_SUBSETS)
    return spark.read.parquet(f"{root}/subsets").select(F.col("subset").cast("int").alias("subset"), "cid", "subset_idx", "uid")


def q_job_merge_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept set at the exact threshold over all shards."""
    root = scratch_path(spark, "job-scores")
    scores = _sharded_scores(spark, sf_dir)
    for shard in ("a_label", "b_nearest"):
        scores.where(F.col("shard") == shard).drop("shard").write.parquet(f"{root}/in/{shard}/similarity")
    jobs.merge_threshold_job(spark, f"{root}/in", f"{root}/kept", KEEP)
    return spark.read.parquet(f"{root}/kept/{kept_set_name(KEEP)}")


def q_job_invert_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "job-ids")
    ids.id_map(_documents(spark, sf_dir), "source").write.parquet(f"{root}/ids")
    jobs.invert_ids_job(spark, f"{root}/ids", f"{root}/inverted")
    return spark.read.parquet(f"{root}/inverted")


# --- text -------------------------------------------------------------------------------------------


def _chunk_rows(chunks: DataFrame) -> DataFrame:
    return chunks.select("uid", "chunk", "n_tokens", F.md5(F.array_join("tokens", " ")).alias("digest"))


def q_token_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunk_rows(chunk.chunk_documents(_documents(spark, sf_dir), CHUNK_SIZE))


def q_instruction_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = chunk.Tokenizer(start=("[CLS]",), end=("[SEP]",))
    return _chunk_rows(chunk.chunk_documents(_documents(spark, sf_dir), CHUNK_SIZE, INSTRUCTION, tokenizer))


def q_plugin_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tokenizer plug-in in place of the built-in white-space cut: single characters as tokens."""
    tokenizer = chunk.Tokenizer(load=lambda: lambda texts: [list(t) for t in texts])
    return _chunk_rows(chunk.chunk_documents(_documents(spark, sf_dir), 1000, tokenizer=tokenizer))


def q_subword_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of subword pieces, the instruction behind the first special token."""
    import public_tokenizers

    tokenizer = subwords.word_pieces(spark, f"file://{public_tokenizers.path(VOCABULARY)}")
    return _chunk_rows(chunk.chunk_documents(_documents(spark, sf_dir), CHUNK_SIZE, INSTRUCTION, tokenizer))


def q_chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.chunk_counts(chunk.chunk_documents(_documents(spark, sf_dir), CHUNK_SIZE))


def q_char_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = chunk.chunk_characters(_documents(spark, sf_dir), 500)
    return pieces.select("uid", "chunk", F.length("piece").alias("n_chars"), F.md5("piece").alias("digest"))


def _components(vectors: DataFrame, *names: str, digits: int = 9) -> DataFrame:
    """Non-zero components, one per row."""
    long = vectors.select(*names, F.posexplode("embedding").alias("pos", "value")).where(F.col("value") != 0)
    return long.select(*names, "pos", _digits(F.col("value").cast("double"), digits).alias("value"))


def q_hashed_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = embed.embed_documents(_documents(spark, sf_dir), embed.HashedWords(DIM), CHUNK_SIZE)
    return _components(vectors, "uid", "n_chunks", digits=5)


def q_chunk_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = chunk.chunk_documents(_documents(spark, sf_dir), CHUNK_SIZE)
    return _components(embed.chunk_vectors(chunks, embed.HashedWords(DIM)), "uid", "chunk")


def q_token_state_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of token states over the real tokens, in micro-batches of chunks of like length."""
    chunks = chunk.chunk_documents(_documents(spark, sf_dir), CHUNK_SIZE)
    return _components(embed.chunk_vectors(chunks, token_states.HashedContext(DIM)), "uid", "chunk")


def q_document_mean_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean over the chunk vectors of a document, before normalisation."""
    chunks = chunk.chunk_documents(_documents(spark, sf_dir), CHUNK_SIZE)
    return _components(embed.document_means(embed.chunk_vectors(chunks, embed.HashedWords(DIM))), "uid")


def q_text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return docs.select("doc_id", F.length("text").alias("length"), F.size(whitespace_tokens(F.col("text"))).alias("n_tokens"))


# --- ids and checks -----------------------------------------------------------------------------------


def q_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index, and the uid chosen from a column that exists and from one that does not."""
    docs = _documents(spark, sf_dir).withColumn("name", F.concat_ws("/", "source", "doc_id"))
    named = ids.id_map(docs, "name")
    plain = ids.id_map(docs, "no_such_column").withColumnRenamed("uid", "fallback")
    return named.join(plain, "idx")


def q_invert_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as repeated uids: the last index wins."""
    return ids.invert_ids(ids.id_map(_documents(spark, sf_dir), "source"))


def q_check_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_counts(_documents(spark, sf_dir), _vectors(spark, sf_dir))


def q_check_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select(_shard_name(F.col("idx")).alias("shard"))
    return checks.check_shards(docs, _vectors(spark, sf_dir).select(_shard_name(F.col("idx")).alias("shard")))


def q_check_shard_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as shards; the label table covers only part of the documents."""
    docs = _documents(spark, sf_dir).select("doc_id", F.concat_ws("-", "source", "lang").alias("shard"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").join(docs, "doc_id")
    vectors = _vectors(spark, sf_dir).join(docs, F.col("uid") == docs.doc_id)
    return checks.check_shard_kinds(documents=docs, labels=labels, vectors=vectors)


def q_check_bijection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mapped to their source are no bijection."""
    docs = _documents(spark, sf_dir)
    return checks.check_bijection(ids.id_map(docs, "source"), docs.select("idx", F.col("lang").alias("uid")))


def q_check_cluster_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select(F.col("lang").alias("shard"), (F.col("n_chars") / 1000).cast("int").alias("cid"))
    return checks.check_cluster_counts(docs)


def q_check_member_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    return checks.check_member_labels(_labelled(vectors), ids.id_map(_documents(spark, sf_dir), "doc_id"))


def q_check_similarity_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    return checks.check_similarity_labels(_labelled(vectors), _label_scores(spark, sf_dir))


def q_check_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = checks.check_centroids(_centroids(_vectors(spark, sf_dir)))
    return report.drop("norm_gap")


def q_check_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed document vectors before normalisation: none is of unit length but one-word texts."""
    chunks = chunk.chunk_documents(_documents(spark, sf_dir), CHUNK_SIZE)
    return checks.check_vectors(embed.document_means(embed.chunk_vectors(chunks, embed.HashedWords(DIM))))


# --- contract -----------------------------------------------------------------------------------------


def _flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors -> clusters -> similarity -> quantile -> pruned documents."""
    vectors = _vectors(spark, sf_dir)
    scores = materialize(max_similarity(_nearest(vectors), vectors), "scores")
    kept = prune.prune_documents(_documents(spark, sf_dir), _keeps(scores), "doc_id")
    return kept.select("doc_id", "lang", "source", "n_chars")


def entry(spark: SparkSession) -> DataFrame:
    """Documents of the smallest test set that survive semantic pruning at 0.8."""
    ship_package(spark)
    return _flagship(spark, SMOKE_DIR)


def _registered(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {name[2:]: f for name, f in globals().items() if name.startswith("q_")}
    if WITH_LLM:
        named |= {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run}
    return {name: _registered(f) for name, f in {"semantic_prune": _flagship, **named}.items()}


def oracle_sql() -> dict[str, str]:
    statements = oracle.statements()
    if WITH_LLM:
        statements |= llm_queries.SQL
        if corpus_pipeline.ORACLE_SQL:
            statements["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {name: sql for name, sql in statements.items() if name in queries()}

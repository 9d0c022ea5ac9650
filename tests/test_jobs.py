"""The jobs end to end on the smallest test set, through the command line where they have options."""

import json

import numpy as np
import pytest
from helpers import SF, brute_scores, collected
from pyspark.sql import functions as F

from semprune.operators import prune
from semprune.plans import cli, jobs


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    """Vectors in four shards, documents, fitted clusters and scores."""
    root = tmp_path_factory.mktemp("jobs")
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    sharded = vectors.select(
        F.floor(F.col("vec_id") / 4).alias("idx"), F.col("vec_id").alias("uid"), "embedding", (F.col("vec_id") % 4).alias("shard")
    )
    sharded.drop("uid").write.partitionBy("shard").parquet(f"{root}/vectors")
    sharded.drop("embedding").write.partitionBy("shard").parquet(f"{root}/ids")
    jobs.merge_embeddings_job(spark, f"{root}/vectors", f"{root}/ids", f"{root}/merged")
    jobs.cluster_job(spark, f"{root}/merged", f"{root}/clusters", n_centroids=8, n_iter=2)
    cli.main(["similarity", "--members", f"{root}/clusters/members", "--vectors", f"{root}/merged", "--output", f"{root}/scores"])
    return root


def test_merged_index_is_contiguous(spark, work):
    merged = spark.read.parquet(f"{work}/merged").orderBy("idx").collect()
    assert [r.idx for r in merged] == list(range(500))
    assert [r.uid for r in merged] == [4 * i + s for s in range(4) for i in range(125)]


def test_scores_equal_brute_force(spark, work):
    merged = spark.read.parquet(f"{work}/merged")
    rows = merged.join(spark.read.parquet(f"{work}/scores/similarity").drop("uid"), "idx").orderBy("idx").collect()
    wanted = brute_scores([r.cid for r in rows], np.array([r.embedding for r in rows], dtype=np.float32))
    np.testing.assert_allclose([r.sim for r in rows], wanted, atol=5e-7)
    quantiles = collected(spark.read.parquet(f"{work}/scores/quantiles"), "q", "value")
    np.testing.assert_allclose([v for _, v in quantiles], np.quantile(wanted, [q for q, _ in quantiles]), atol=5e-7)


def test_saved_centroids_give_the_same_members(spark, work):
    jobs.cluster_job(spark, f"{work}/merged", f"{work}/again", centroids=f"{work}/clusters/centroids")
    assert collected(spark.read.parquet(f"{work}/again/members"), "uid", "cid", "ord") == collected(
        spark.read.parquet(f"{work}/clusters/members"), "uid", "cid", "ord"
    )
    assert spark.read.parquet(f"{work}/again/sizes").count() == 8


def test_train_only(spark, work):
    jobs.cluster_job(spark, f"{work}/merged", f"{work}/trained", n_centroids=3, n_iter=1, train_only=True)
    assert spark.read.parquet(f"{work}/trained/centroids").count() == 3
    assert not (work / "trained" / "members").exists()


def test_prune(spark, work):
    target = jobs.prune_job(spark, f"{SF}/documents.parquet", f"{work}/scores", f"{work}/pruned", 0.8, uid_key="doc_id", index_key="doc_id")
    kept = spark.read.parquet(target)
    totals = json.loads(next((work / "pruned" / "statistics" / "totals").glob("*.json")).read_text())
    assert totals["n_samples"] == kept.count() and totals["n_samples"] + totals["removed"] == 200
    assert totals["mean_length"] == pytest.approx(kept.agg(F.avg(F.length("text"))).first()[0])
    assert kept.columns == spark.read.parquet(f"{SF}/documents.parquet").columns


def test_unknown_fraction_fails_before_work(spark, work):
    with pytest.raises(KeyError):
        jobs.prune_job(spark, f"{SF}/documents.parquet", f"{work}/scores", f"{work}/never", 0.77, uid_key="doc_id")
    with pytest.raises(KeyError):
        jobs.flags_job(spark, f"{work}/scores", f"{work}/never", [0.5, 0.77])
    assert not (work / "never").exists()


def test_flags_and_flag_pruning(spark, work):
    cli.main(["flags", "--scores", f"{work}/scores", "--output", f"{work}/flags", "--keep", "0.5", "0.8"])
    kept = spark.read.parquet(f"{work}/flags/keep_0pt8").where("keep")
    scores = spark.read.parquet(f"{work}/scores/similarity")
    threshold = spark.read.parquet(f"{work}/scores/quantiles").where("q = 0.8").first().value
    assert collected(kept, "uid") == collected(scores.where(F.col("sim") < threshold), "uid")
    assert spark.read.parquet(f"{work}/flags/keep_0pt5").count() == 500
    by_flags = jobs.prune_job(
        spark, f"{SF}/documents.parquet", f"{work}/flags", f"{work}/pruned-by-flags", 0.8, uid_key="doc_id", index_key="doc_id", flags=True
    )
    by_scores = jobs.prune_job(
        spark, f"{SF}/documents.parquet", f"{work}/scores", f"{work}/pruned-by-scores", 0.8, uid_key="doc_id", index_key="doc_id"
    )
    assert collected(spark.read.parquet(by_flags), "doc_id") == collected(spark.read.parquet(by_scores), "doc_id")


@pytest.mark.parametrize("rule, kept", [("last", 0), ("max", 0), ("error", None)])
def test_repeated_uids_have_one_value(spark, tmp_path, rule, kept):
    root = str(tmp_path)
    spark.createDataFrame([(1, 0, 7, 0.9), (0, 5, 7, 0.1)], "cid int, ord long, uid long, sim double").write.parquet(f"{root}/s/similarity")
    spark.createDataFrame([(0.8, 0.5)], "q double, value double").write.parquet(f"{root}/s/quantiles")
    spark.createDataFrame([(7, "a text", "src")], "uid long, text string, source string").write.parquet(f"{root}/docs")
    run = lambda: jobs.prune_job(spark, f"{root}/docs", f"{root}/s", f"{root}/out", 0.8, uid_key="uid", rule=rule)
    if kept is None:
        with pytest.raises(Exception, match="repeated uid"):
            run()
        return
    assert spark.read.parquet(run()).count() == kept
    totals = spark.read.json(f"{root}/out/statistics/totals").first()
    assert (totals.found, totals.removed) == (1, 1 - kept)


@pytest.mark.parametrize("exact", [True, False])
def test_merged_results(spark, work, exact):
    scores = spark.read.parquet(f"{work}/scores/similarity")
    shards = f"{work}/shards{exact}"
    for shard, shift in (("a", 0.0), ("b", 0.1)):
        scores.select("uid", "ord", (F.col("sim") + shift).alias("sim")).write.parquet(f"{shards}/{shard}")
    jobs.merge_threshold_job(spark, shards, f"{work}/set{exact}", 0.5, exact=exact)
    jobs.merge_similarity_job(spark, shards, f"{work}/merged_scores{exact}", exact=exact, delete_inputs=True)
    assert not (work / f"shards{exact}").exists()
    merged = spark.read.parquet(f"{work}/merged_scores{exact}/similarity")
    joined = merged.join(scores.select("uid", F.col("sim").alias("old")), "uid")
    assert joined.count() == 500 and joined.where("abs(sim - old - 0.1) > 1e-12").count() == 0
    stacked = np.array([s + d for (s,) in collected(scores, "sim") for d in (0, 0.1)])
    median = spark.read.parquet(f"{work}/merged_scores{exact}/quantiles").where("q = 0.5").first().value
    if exact:
        assert median == pytest.approx(np.median(stacked))
    kept = spark.read.parquet(f"{work}/set{exact}/similarities_0pt5")
    threshold = spark.read.parquet(f"{work}/set{exact}/quantiles").where("q = 0.5").first().value
    assert collected(kept, "uid") == collected(scores.where(F.col("sim") < threshold), "uid")
    target = jobs.prune_job(
        spark, f"{SF}/documents.parquet", f"{work}/scores", f"{work}/by_set{exact}", 0.5, uid_key="doc_id", index_key="doc_id",
        kept_set=f"{work}/set{exact}/similarities_0pt5",
    )
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("idx", F.col("doc_id"))
    assert collected(spark.read.parquet(target), "doc_id") == collected(prune.prune_to_set(docs, kept, "doc_id"), "doc_id")


def test_regroup(spark, work):
    members = spark.read.parquet(f"{work}/clusters/members")
    merged = spark.read.parquet(f"{work}/merged")
    merged.select("uid", "embedding", "shard").write.partitionBy("shard").parquet(f"{work}/vector_shards")
    jobs.regroup_job(spark, f"{work}/clusters/members", f"{work}/vector_shards", f"{work}/subsets", n_clusters=8, n_subsets=3)
    rows = spark.read.parquet(f"{work}/subsets").collect()
    assert len(rows) == members.count()
    for subset in range(3):
        mine = sorted(r.subset_idx for r in rows if r.subset == subset)
        assert mine == list(range(len(mine)))
    order = [(r.subset, r.shard, r.cid) for r in sorted(rows, key=lambda r: (r.subset, r.subset_idx))]
    assert order == sorted(order)


def test_merge_clusters(spark, work):
    members = spark.read.parquet(f"{work}/clusters/members")
    for shard in ("a", "b"):
        members.write.parquet(f"{work}/lists/{shard}")
    jobs.merge_clusters_job(spark, f"{work}/lists", f"{work}/lists_merged")
    merged = spark.read.parquet(f"{work}/lists_merged")
    sizes = dict(collected(members.groupBy("cid").count(), "cid", "count"))
    for cid, size in sizes.items():
        assert [o for (o,) in collected(merged.where(F.col("cid") == cid), "ord")] == list(range(2 * size))
    members.where("cid < 7").write.parquet(f"{work}/lists/c")
    with pytest.raises(ValueError, match="numbers of clusters"):
        jobs.merge_clusters_job(spark, f"{work}/lists", f"{work}/never_merged")


def test_text_jobs(spark, work):
    cli.main(["chunk", "--documents", f"{SF}/documents.parquet", "--output", f"{work}/chunks", "--chunk-size", "64", "--instruction", "none", "--index-key", "doc_id"])
    assert spark.read.parquet(f"{work}/chunks").agg(F.max("n_tokens")).first()[0] == 64
    report = jobs.embed_job(spark, f"{SF}/documents.parquet", f"{work}/embedded", dim=32, uid_key="doc_id", index_key="doc_id").first()
    assert report.n_vectors == 200 and report.ok
    jobs.invert_ids_job(spark, f"{work}/embedded/ids", f"{work}/inverse")
    assert spark.read.parquet(f"{work}/inverse").columns == ["uid", "idx"]
    jobs.cluster_job(spark, f"{work}/embedded/vectors", f"{work}/text_clusters", 4, 1, id_map=f"{work}/embedded/ids")
    assert spark.read.parquet(f"{work}/text_clusters/members").count() == 200


def test_matrix_import(spark, work):
    data = np.arange(12, dtype=np.float32).reshape(4, 3)
    data.tofile(work / "raw.npy")
    jobs.import_matrix_job(spark, f"{work}/raw.npy", f"{work}/imported", dim=3)
    rows = spark.read.parquet(f"{work}/imported").orderBy("idx").collect()
    assert [r.uid for r in rows] == [0, 1, 2, 3] and rows[3].embedding == [9, 10, 11]


def test_every_job_has_a_command():
    parser = cli.build_parser()
    with pytest.raises(SystemExit):
        parser.parse_args(["prune"])
    options = parser.parse_args(["prune", "--documents", "d", "--scores", "s", "--output", "o", "--keep", "0.8", "--split", "none"])
    assert options.job is jobs.prune_job and options.keep == 0.8 and options.split is None

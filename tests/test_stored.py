"""Results that are stored to be merged or used later: sketches, pages of kept uids, observed statistics, co-located tables."""

import numpy as np
import pytest
from helpers import brute_scores, collected, random_unit, vectors_of
from pyspark.sql import functions as F

from semprune.operators import kept_pages, merge, prune, quantiles, sketches
from semprune.operators.clusters import order_members
from semprune.operators.similarity import max_similarity
from semprune.plans import jobs
from semprune.session import materialize
from semprune.sources import layout


def score_table(spark, rows):
    return spark.createDataFrame(rows, "shard string, uid long, sim double")


# --- sketches --------------------------------------------------------------------------------


def test_few_rows_are_exact(spark):
    r = np.random.default_rng(1)
    values = r.normal(size=400)
    scores = score_table(spark, [(f"s{i % 3}", i, float(v)) for i, v in enumerate(values)] + [("s0", 1000, None), ("s9", 1001, None)])
    stored = sketches.sketches(scores, ["shard"])
    assert {(x.shard, x.n) for x in stored.collect()} == {("s0", 134), ("s1", 133), ("s2", 133)}
    rows = sketches.sketch_quantiles(sketches.merge_sketches(stored), [0.0, 0.5, 0.9, 1.0]).collect()
    for x in rows:
        assert x.low <= np.quantile(values, x.q) <= x.high and x.low <= x.value <= x.high
        assert abs((values <= x.value).mean() - x.q) <= 1 / 400 + 1e-9


def test_many_rows_lie_within_the_bound(spark):
    k = 64
    rows = spark.range(60_000).select(F.concat(F.lit("s"), F.col("id") % 7).alias("shard"), F.col("id").alias("uid"), F.pow(F.rand(3), F.lit(2.0)).alias("sim"))
    rows = materialize(rows.unionByName(rows.where("uid < 9000").withColumn("sim", F.lit(1.0))), "scores")
    merged = sketches.merge_sketches(sketches.sketches(rows, ["shard"], k=k))
    exact = {x.q: x.value for x in quantiles.quantiles(rows).collect()}
    found = sketches.sketch_quantiles(merged).collect()
    assert len(found) == 19 and len(bytes(merged.first().sketch)) < 3000
    # a bound at 99% for each point
    assert sum(not x.low <= exact[x.q] <= x.high for x in found) <= 1
    assert any(x.low < x.high for x in found)


def test_no_scores(spark):
    none = score_table(spark, [])
    assert sketches.sketches(none).count() == 0
    assert sketches.sketch_quantiles(sketches.merge_sketches(sketches.sketches(none, ["shard"]))).count() == 0


def test_jobs_store_and_merge_sketches(spark, tmp_path):
    path = lambda *names: "/".join([str(tmp_path), *names])
    r = np.random.default_rng(3)
    v = random_unit(r, 120, 5)
    vectors = vectors_of(spark, [(i, i % 2, x) for i, x in enumerate(v)])
    members = materialize(order_members(vectors), "members")
    vectors.write.parquet(path("vectors"))
    for cid in (0, 1):
        members.where(F.col("cid") == cid).write.parquet(path("members", str(cid)))
        jobs.similarity_job(spark, path("members", str(cid)), path("vectors"), path("scores", str(cid)))
    jobs.merge_similarity_job(spark, path("scores"), path("exact"))
    jobs.merge_similarity_job(spark, path("scores"), path("sketched"), sketch=True)
    exact = {x.q: x.value for x in spark.read.parquet(path("exact", "quantiles")).collect()}
    for x in spark.read.parquet(path("sketched", "quantiles")).collect():
        assert x.low <= exact[x.q] <= x.high
    assert quantiles.threshold_at(spark.read.parquet(path("sketched", "quantiles")), 0.8) > 0


# --- pages of kept uids ----------------------------------------------------------------------


def some_scores(spark):
    r = np.random.default_rng(5)
    uids = [0, 1, -1, -32768, 32767, 32768, 32769, -40000, 10**12, 10**12 + 1, *r.integers(-100_000, 100_000, 300).tolist()]
    rows = [(f"s{i % 3}", int(u), float(r.random())) for i, u in enumerate(uids)]
    rows += [("s1", u, s) for _, u, s in rows[:40]] + rows[:5] + [("s2", 5, None), ("s0", 7, 0.3)]
    return score_table(spark, rows)


def test_sets_and_counts_come_from_pages(spark):
    scores = some_scores(spark)
    for threshold in (0.0, 0.4, 2.0):
        pages = materialize(kept_pages.kept_pages(scores, threshold), "pages")
        want = collected(merge.kept_set(scores, threshold), "uid")
        assert collected(kept_pages.page_uids(kept_pages.merged_pages(pages)), "uid") == want
        counts = kept_pages.page_counts(pages).first()
        plain = merge.kept_counts(scores, threshold).first()
        assert (counts.kept, counts.removed, counts.kept_share, counts.distinct_kept) == (plain.kept, plain.removed, plain.kept_share, len(want))


@pytest.mark.parametrize("limit", [1 << 29, 0])
def test_documents_are_pruned_by_stored_pages(spark, monkeypatch, limit):
    monkeypatch.setattr(prune, "BITMAP_LIMIT", limit)
    scores = some_scores(spark)
    docs = spark.createDataFrame([(i, u, "t" * (i % 9)) for i, u in enumerate([*range(-40, 40), 32768, 10**12, 77, None, -40000])], "idx long, uid long, text string")
    pages = kept_pages.merged_pages(kept_pages.kept_pages(scores, 0.6))
    kept = {r.uid for r in merge.kept_set(scores, 0.6).collect()}
    found = prune.prune_to_pages(docs, pages, "uid")
    assert found.columns == docs.columns
    assert sorted(r.idx for r in found.collect()) == [r.idx for r in docs.orderBy("idx").collect() if r.uid in kept]


def test_no_pages(spark):
    pages = kept_pages.kept_pages(score_table(spark, []), 0.5)
    assert kept_pages.page_counts(pages).first().asDict() == {"kept": 0, "removed": 0, "kept_share": None, "distinct_kept": 0}
    docs = spark.createDataFrame([(1, "x")], "idx long, text string")
    assert prune.prune_to_pages(docs, kept_pages.merged_pages(pages)).count() == 0


# --- statistics from the write ---------------------------------------------------------------


def documents(spark, kind):
    name = (lambda i: i) if kind == "long" else (lambda i: f"d{i}")
    rows = [(i, None if i % 10 == 9 else name(i % 45), None if i % 7 == 6 else f"src{i % 4}", "x" * (i % 13)) for i in range(60)]
    docs = spark.createDataFrame(rows, f"idx long, uid {kind}, source string, text string").repartition(3)
    keeps = spark.createDataFrame([(name(i), i % 3 > 0) for i in range(0, 40) if i % 5], f"uid {kind}, keep boolean")
    return docs, materialize(keeps, "keeps")


@pytest.mark.parametrize("kind,index,limit", [("long", True, 1 << 29), ("string", True, 1 << 29), ("string", False, 1 << 29), ("long", False, 0)])
def test_observed_statistics_equal_those_of_a_second_pass(spark, tmp_path, monkeypatch, kind, index, limit):
    monkeypatch.setattr(prune, "BITMAP_LIMIT", limit)
    docs, keeps = documents(spark, kind)
    docs = docs if index else docs.drop("idx")
    judged = prune.judge(docs, keeps, "uid", "source")
    pruned = prune.ObservedPrune(docs, keeps, "uid", "source")
    pruned.kept.write.parquet(str(tmp_path / "out"))
    assert pruned.totals().first() == prune.totals(judged).first()
    assert sorted(pruned.source_totals().collect()) == sorted(prune.source_totals(judged).collect())
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.columns == docs.columns
    assert sorted(map(str, written.collect())) == sorted(map(str, prune.prune_documents(docs, keeps, "uid").select(*docs.columns).collect()))


def test_one_scan_of_the_documents(spark, tmp_path, capsys):
    docs, keeps = documents(spark, "long")
    docs.write.parquet(str(tmp_path / "docs"))
    pruned = prune.ObservedPrune(spark.read.parquet(str(tmp_path / "docs")), keeps, "uid", "source")
    pruned.kept.explain()
    plan = capsys.readouterr().out
    assert plan.count("text#") and plan.count(f"{tmp_path}/docs") == 1 and "SortMergeJoin" not in plan


def test_a_write_that_failed_leaves_nothing_behind(spark, tmp_path):
    docs, keeps = documents(spark, "long")
    want = prune.totals(prune.judge(docs, keeps, "uid")).first()
    broken = docs.withColumn("text", F.when(F.col("idx") == 33, F.raise_error(F.lit("broken row"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="broken row"):
        prune.ObservedPrune(broken, keeps, "uid").kept.write.parquet(str(tmp_path / "out"))
    again = prune.ObservedPrune(docs, keeps, "uid")
    again.kept.write.mode("overwrite").parquet(str(tmp_path / "out"))
    assert again.totals().first() == want


def test_too_many_sources_are_left_to_another_pass(spark, monkeypatch):
    monkeypatch.setattr(prune, "OBSERVED_SOURCES", 3)
    docs, keeps = documents(spark, "long")
    pruned = prune.ObservedPrune(docs, keeps, "uid", "source")
    assert pruned.kept.count() > 0 and pruned.source_totals() is None


def test_nothing_kept(spark):
    docs, keeps = documents(spark, "long")
    pruned = prune.ObservedPrune(docs.limit(0), keeps, "uid", "source")
    assert pruned.kept.count() == 0
    assert pruned.totals().first() == prune.totals(prune.judge(docs.limit(0), keeps, "uid")).first()


# --- co-located tables -----------------------------------------------------------------------


def test_members_and_vectors_join_without_an_exchange(spark, tmp_path, capsys):
    r = np.random.default_rng(8)
    v = random_unit(r, 90, 4)
    vectors = vectors_of(spark, [(i, i % 3, x) for i, x in enumerate(v)])
    layout.write_colocated(order_members(vectors), vectors, "near", str(tmp_path / "tables"), 5)
    # as another session would, from the files alone
    members, stored = layout.read_colocated(spark, "again", str(tmp_path / "tables"), 5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        members.join(stored, "idx").explain()
        plan = capsys.readouterr().out
        assert "SortMergeJoin" in plan and "Exchange " not in plan and "Exchange(" not in plan and "hashpartitioning" not in plan
        found = {x.uid: x.sim for x in max_similarity(members, stored).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    np.testing.assert_allclose([found[i] for i in range(90)], brute_scores([i % 3 for i in range(90)], v), rtol=1e-12)
    for name in ("near", "again"):
        for kind in ("members", "vectors"):
            spark.sql(f"DROP TABLE {name}_{kind}")

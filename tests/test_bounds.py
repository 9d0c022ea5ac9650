"""Bounds that rule out products: the results of the plain operators, and fewer products."""

import itertools

import numpy as np
import pytest
from helpers import brute_scores, collected, random_unit, vectors_of
from pyspark.sql import functions as F

from semprune.operators import centroid_index, kmeans, kmeans_bounds, similarity, similarity_pruned
from semprune.operators.assign import assign_nearest, best_match
from semprune.operators.checks import check_centroid_index
from semprune.operators.clusters import order_members
from semprune.operators.positions import position_by_key
from semprune.plans import jobs
from semprune.session import materialize
from semprune.sources import sinks, tables


def blobs(seed, n_blobs, n, dim, spread):
    rng = np.random.default_rng(seed)
    v = random_unit(rng, n_blobs, dim)[rng.integers(0, n_blobs, n)] + rng.normal(scale=spread, size=(n, dim))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def table(spark, v, cids=None):
    return vectors_of(spark, [(i, 0 if cids is None else cids[i], x) for i, x in enumerate(v)])


def centroid_rows(df):
    return {r.cid: np.array(r.centroid) for r in df.collect()}


def same_centroids(a, b):
    a, b = centroid_rows(a), centroid_rows(b)
    assert a.keys() == b.keys()
    for cid in a:
        np.testing.assert_allclose(a[cid], b[cid], atol=1e-6)


# --- k-means ---------------------------------------------------------------------------------


def test_bounded_iterations_equal_plain_ones_and_skip_products(spark):
    v = blobs(1, 30, 3000, 24, 0.03)
    vectors = table(spark, v)
    fitted, report = kmeans_bounds.fit_kmeans_bounded(vectors, 40, 8)
    same_centroids(fitted, kmeans.fit_kmeans(vectors, 40, 8))
    rows = report.orderBy("iteration").collect()
    assert [r.iteration for r in rows] == list(range(8)) and all(r.all_products == 3000 * 40 for r in rows)
    assert rows[0].products == 3000 * 40
    assert sum(r.products for r in rows[3:]) < 0.25 * sum(r.all_products for r in rows[3:])


def test_bounded_iterations_with_copies_zeros_and_any_length(spark):
    rng = np.random.default_rng(2)
    v = (random_unit(rng, 300, 5) * rng.integers(0, 4, (300, 1))).astype(np.float32)
    v[rng.choice(300, 200)] = v[rng.integers(0, 6, 200)]
    vectors = table(spark, v)
    same_centroids(kmeans_bounds.fit_kmeans_bounded(vectors, 12, 5)[0], kmeans.fit_kmeans(vectors, 12, 5))


def test_beyond_the_limit_nothing_is_skipped(spark):
    vectors = table(spark, blobs(3, 4, 60, 6, 0.1))
    fitted, report = kmeans_bounds.fit_kmeans_bounded(vectors, 5, 2, broadcast_limit=100)
    same_centroids(fitted, kmeans.fit_kmeans(vectors, 5, 2))
    assert [(r.products, r.all_products) for r in report.collect()] == [(300, 300)] * 2


def test_no_number_is_rejected(spark):
    with pytest.raises(Exception, match="no number"):
        kmeans_bounds.fit_kmeans_bounded(table(spark, np.array([[1, 0], [0, float("nan")], [0, 1]], np.float32)), 2, 2)


def test_bounds_hold_after_any_move():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 6)) * rng.integers(0, 3, (500, 1))
    matrix = random_unit(rng, 24, 6).astype(np.float64)
    held = kmeans_bounds.Centroids(np.arange(24) * 3, matrix, kmeans_bounds.centroid_groups(matrix, 5), np.zeros(24))
    own, lower, upper = kmeans_bounds.all_products(x, held)
    for scale in (0.01, 0.5, 0.001, 0.0):
        matrix = matrix + rng.normal(size=matrix.shape) * scale
        held = held.next(matrix)
        own, lower, upper, _ = kmeans_bounds.tightened(x, own, lower, upper, held)
        sims = x @ matrix.T
        rows = np.arange(len(x))
        nonzero = np.abs(x).sum(axis=1) > 0
        assert (own[nonzero] == sims.argmax(axis=1)[nonzero]).all()
        assert (lower <= sims[rows, own] + 1e-9).all()
        sims[rows, own] = -np.inf
        for g, members in enumerate(held.members):
            assert (upper[:, g] >= sims[:, members].max(axis=1) - 1e-9).all()


# --- index of centroids ----------------------------------------------------------------------


def centroid_table(spark, matrix):
    return spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(matrix)], "cid int, centroid array<float>")


@pytest.mark.parametrize("k,groups", [(1, None), (2, None), (50, None), (50, 50), (50, 1)])
def test_index_finds_the_nearest(spark, k, groups):
    centroids = centroid_table(spark, blobs(5, 6, k, 8, 0.1))
    index = materialize(centroid_index.build_index(centroids, groups), "index")
    vectors = table(spark, blobs(6, 6, 400, 8, 0.2)).select("idx", "embedding")
    plain = collected(assign_nearest(vectors, centroids, ["idx"]), "idx", "cid", "centroid_sim")
    found = collected(centroid_index.assign_indexed(vectors, centroids, index, ["idx"]), "idx", "cid", "centroid_sim")
    assert [r[:2] for r in found] == [r[:2] for r in plain]
    assert [r[2] for r in found] == pytest.approx([r[2] for r in plain])


def test_ties_go_to_the_lowest_id_in_any_group(spark):
    matrix = np.concatenate([random_unit(np.random.default_rng(1), 30, 6)] * 2)
    centroids = centroid_table(spark, matrix)
    index = materialize(centroid_index.build_index(centroids, 9), "index")
    vectors = table(spark, np.concatenate([matrix, np.zeros((1, 6), np.float32)])).select("idx", "embedding")
    found = collected(centroid_index.assign_indexed(vectors, centroids, index), "idx", "cid")
    assert found == [(i, i % 30 if i < 60 else 0) for i in range(61)]


def test_index_saves_products(spark):
    centroids = centroid_table(spark, blobs(7, 20, 400, 16, 0.02))
    index = materialize(centroid_index.build_index(centroids), "index")
    groups = centroid_index._loaded(centroids, index, 16)
    x = blobs(7, 20, 900, 16, 0.02).astype(np.float64)
    best, place, products = centroid_index.search(x, groups)
    assert (place == best_match(x, groups.matrix)[1]).all()
    assert products < 0.4 * len(x) * 400


def test_centroids_and_index_belong_together(spark, tmp_path):
    one, other = (centroid_table(spark, blobs(s, 3, 12, 4, 0.2)) for s in (1, 2))
    sinks.write_indexed_centroids(one, str(tmp_path / "one"))
    centroids, index = tables.read_indexed_centroids(spark, str(tmp_path / "one"))
    assert check_centroid_index(centroids, index).first().ok
    assert not check_centroid_index(other, index).first().ok
    assert not check_centroid_index(centroids, index.where("cid > 0")).first().ok
    assert not check_centroid_index(centroids, index.limit(0)).first().ok
    sinks.write_centroids(one, str(tmp_path / "alone" / "centroids"))
    with pytest.raises(FileNotFoundError, match="index"):
        tables.read_indexed_centroids(spark, str(tmp_path / "alone"))
    index.write.parquet(str(tmp_path / "half" / "index"))
    with pytest.raises(FileNotFoundError, match="centroids"):
        tables.read_indexed_centroids(spark, str(tmp_path / "half"))


def test_cluster_job_saves_and_takes_both(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    table(spark, blobs(8, 5, 200, 8, 0.05)).drop("cid").write.parquet(path("vectors"))
    jobs.cluster_job(spark, path("vectors"), path("trained"), 6, 4)
    jobs.cluster_job(spark, path("vectors"), path("again"), saved=path("trained"))
    jobs.cluster_job(spark, path("vectors"), path("plain"), 6, 4, bounds=False)
    members = [collected(spark.read.parquet(f"{path(n)}/members"), "cid", "ord", "idx", "uid") for n in ("trained", "again", "plain")]
    assert members[0] == members[1] == members[2]
    assert spark.read.json(f"{path('trained')}/products").count() == 4
    jobs.cluster_job(spark, path("vectors"), path("sampled"), 6, 2, max_points_per_centroid=10, train_only=True)
    assert spark.read.json(f"{path('sampled')}/products").agg(F.max("all_products")).first()[0] == 60 * 6


# --- similarity: new shards ------------------------------------------------------------------


@pytest.mark.parametrize("tile_rows,hot_copies", [(None, 100_000), (7, 100_000), (16, 3)])
def test_shard_by_shard_equals_all_at_once(spark, tile_rows, hot_copies):
    rng = np.random.default_rng(10)
    v = (random_unit(rng, 240, 4) * rng.integers(0, 5, (240, 1))).astype(np.float32)
    v[rng.choice(240, 150)] = v[rng.integers(0, 15, 150)]
    cids = np.where(np.arange(240) < 200, rng.integers(0, 3, 240), rng.integers(2, 5, 240))
    vectors = table(spark, v, cids)
    members = materialize(order_members(vectors), "members")
    scores = [similarity.max_similarity(members.where("idx < 60"), vectors, tile_rows, hot_copies)]
    for a, b in itertools.pairwise((60, 61, 150, 240)):
        new = members.where(F.col("idx").between(a, b - 1))
        scores.append(similarity.new_similarity(members.where(F.col("idx") < a), new, vectors, tile_rows, hot_copies))
    rows = sorted((r.uid, r.sim) for s in scores for r in s.collect())
    assert [r[0] for r in rows] == list(range(240))
    np.testing.assert_allclose([r[1] for r in rows], brute_scores(cids, v), rtol=1e-12, atol=1e-12)


def test_old_pairs_are_not_formed(spark):
    v = blobs(11, 4, 100, 6, 0.2)
    vectors = table(spark, v, np.arange(100) % 2)
    members = materialize(order_members(vectors), "members")
    narrow = similarity._with_traits(members.where("idx >= 80 AND cid = 1"), vectors)
    placed = similarity._new_distinct(members.where("idx < 80"), narrow, vectors)
    pairs = similarity.tile_rows_of_pairs(placed, vectors, 8)
    found = pairs.groupBy("cid", "first", "second").agg(F.max("pos").alias("last"), F.min("pos").alias("low")).collect()
    # 40 earlier rows of the cluster are five tiles, ten new ones two; the other cluster is not read
    assert {r.cid for r in found} == {1}
    assert sorted((r.first, r.second) for r in found) == sorted([(a, b) for a in range(5) for b in (5, 6)] + [(5, 5), (5, 6), (6, 6)])
    assert all(r.last >= 40 for r in found)


def test_new_members_must_follow(spark):
    vectors = table(spark, blobs(12, 2, 20, 4, 0.2))
    members = materialize(order_members(vectors), "members")
    with pytest.raises(ValueError, match="follow"):
        similarity.new_similarity(members.where("idx >= 10"), members.where("idx < 10"), vectors)


def test_similarity_job_scores_a_new_shard(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    v = blobs(13, 3, 60, 5, 0.3)
    vectors = table(spark, v)
    members = materialize(order_members(vectors), "members")
    vectors.write.parquet(path("vectors"))
    members.where("idx < 40").write.parquet(path("old"))
    members.where("idx >= 40").write.parquet(path("new"))
    jobs.similarity_job(spark, path("new"), path("vectors"), path("scores"), earlier_members=path("old"))
    got = collected(spark.read.parquet(path("scores") + "/similarity"), "uid", "sim")
    np.testing.assert_allclose([r[1] for r in got], brute_scores([0] * 60, v)[40:], rtol=1e-12)


# --- similarity: tiles ruled out -------------------------------------------------------------


@pytest.mark.parametrize("seed,tile_rows", [(1, 6), (2, 20), (3, None)])
def test_pruned_scores_equal_brute_force(spark, seed, tile_rows):
    rng = np.random.default_rng(seed)
    v = (blobs(seed, 8, 300, 4, 0.1) * rng.integers(0, 4, (300, 1))).astype(np.float32)
    v[rng.choice(300, 120)] = v[rng.integers(0, 20, 120)]
    cids = np.where(rng.random(300) < 0.7, 0, rng.integers(1, 4, 300))
    vectors = table(spark, v, cids)
    rows = similarity_pruned.max_similarity_pruned(order_members(vectors), vectors, tile_rows, hot_copies=10).collect()
    sims = dict((r.uid, r.sim) for r in rows)
    np.testing.assert_allclose([sims[i] for i in range(300)], brute_scores(cids, v), rtol=1e-12, atol=1e-12)


def _placed(spark, vectors):
    narrow = similarity._with_traits(order_members(vectors), vectors)
    return materialize(position_by_key(similarity._firsts(narrow), ["cid"], "ord", "pos", size_out="n_distinct"), "distinct")


def test_most_tiles_of_clear_neighbourhoods_are_ruled_out(spark):
    v = blobs(21, 12, 600, 16, 0.01)
    vectors = table(spark, v)
    scores, visits = similarity_pruned.score_distinct_pruned(_placed(spark, vectors), vectors, 50)
    np.testing.assert_allclose([r[1] for r in collected(scores, "pos", "sim")], brute_scores([0] * 600, v), rtol=1e-12)
    visited = visits.select(F.sum(F.size("visited"))).first()[0]
    # some twenty tiles, each row would visit all others
    assert visited < 0.35 * 600 * 11


def test_small_tiles_of_a_large_cluster_are_taken_together(spark):
    v = random_unit(np.random.default_rng(23), 400, 16)
    vectors = table(spark, v)
    scores, visits = similarity_pruned.score_distinct_pruned(_placed(spark, vectors), vectors, 2)
    np.testing.assert_allclose([r[1] for r in collected(scores, "pos", "sim")], brute_scores([0] * 400, v), rtol=1e-12, atol=1e-12)
    # 32 tiles of 13 rows and 100 pivots, whereas tiles of two rows would be 400
    assert 0 < visits.select(F.max(F.size("visited"))).first()[0] <= 132


def test_too_many_centres_are_not_sent(spark):
    v = blobs(22, 3, 80, 4, 0.1)
    vectors = table(spark, v)
    scores, visits = similarity_pruned.score_distinct_pruned(_placed(spark, vectors), vectors, 10, limit=16)
    assert visits is None
    np.testing.assert_allclose([r[1] for r in collected(scores, "pos", "sim")], brute_scores([0] * 80, v), rtol=1e-12)


def test_no_rows(spark):
    vectors = table(spark, []).select("idx", "uid", "cid", "embedding")
    assert similarity_pruned.max_similarity_pruned(order_members(vectors), vectors).count() == 0
    members = order_members(vectors)
    assert similarity.new_similarity(members, members, vectors).count() == 0

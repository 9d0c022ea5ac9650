import numpy as np
import pytest
from helpers import collected, random_unit, vectors_of
from pyspark.sql import functions as F

from semprune.operators import checks, kmeans
from semprune.operators.assign import assign_nearest


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(3)
    centers = random_unit(rng, 6, 12)
    v = centers[rng.integers(0, 6, 240)] + rng.normal(scale=0.05, size=(240, 12))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def centroid_table(spark, matrix):
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(matrix)]
    return spark.createDataFrame(rows, "cid int, centroid array<float>")


def fit(spark, v, **options):
    vectors = vectors_of(spark, [(i, 0, x) for i, x in enumerate(v)])
    return vectors, kmeans.fit_kmeans(vectors, **options)


@pytest.mark.parametrize("limit", [1 << 30, 8 * 12 * 2])
def test_assignment_equals_argmax(spark, blobs, limit):
    centroids = random_unit(np.random.default_rng(8), 9, 12)
    vectors = vectors_of(spark, [(i, 0, x) for i, x in enumerate(blobs)]).drop("cid", "uid")
    found = assign_nearest(vectors, centroid_table(spark, centroids), broadcast_limit=limit)
    sims = blobs.astype(np.float64) @ centroids.T.astype(np.float64)
    rows = collected(found, "idx", "cid", "centroid_sim")
    assert [r[1] for r in rows] == sims.argmax(axis=1).tolist()
    assert [r[2] for r in rows] == pytest.approx(sims.max(axis=1).tolist())


@pytest.mark.parametrize("limit", [1 << 30, 8 * 2])
def test_ties_go_to_the_lowest_id(spark, limit):
    vectors = vectors_of(spark, [(0, 0, (1, 0))]).drop("cid")
    centroids = spark.createDataFrame([(3, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "cid int, centroid array<float>")
    assert assign_nearest(vectors, centroids, broadcast_limit=limit).first().cid == 1


@pytest.mark.parametrize("limit", [1 << 30, 8 * 2])
def test_every_row_is_assigned_whatever_is_kept(spark, limit):
    vectors = vectors_of(spark, [(0, 0, (1, 0)), (1, 0, (1, 0)), (2, 0, (0, 1))]).select(F.lit("same").alias("name"), "embedding")
    centroids = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "cid int, centroid array<float>")
    assert collected(assign_nearest(vectors, centroids, ["name"], limit), "name", "cid") == [("same", 0), ("same", 0), ("same", 1)]


def test_no_number_is_rejected(spark):
    vectors = vectors_of(spark, [(0, 0, (1, float("nan")))])
    centroids = spark.createDataFrame([(0, [1.0, 0.0])], "cid int, centroid array<float>")
    with pytest.raises(Exception, match="no number"):
        assign_nearest(vectors.select("idx", "embedding"), centroids).collect()


def test_training_takes_all_rows(spark):
    v = random_unit(np.random.default_rng(5), 1500, 3)
    v[-1] = (0, 0, 1)
    vectors, fitted = fit(spark, v, k=2, n_iter=1)
    start = kmeans.initial_centroids(vectors.select("idx", "embedding"), 2, kmeans.SEED).orderBy("cid").collect()
    labels = (v.astype(np.float64) @ np.array([r.centroid for r in start]).T).argmax(1)
    means = np.array([v[labels == k].astype(np.float64).sum(0) for k in range(2)])
    means /= np.linalg.norm(means, axis=1, keepdims=True)
    assert np.array([r.centroid for r in fitted.orderBy("cid").collect()]) == pytest.approx(means, abs=1e-6)


def test_bad_inputs_are_rejected(spark):
    vectors = vectors_of(spark, [(0, 0, (1, 0))])
    mixed = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0])], "cid int, centroid array<float>")
    with pytest.raises(ValueError):
        assign_nearest(vectors, mixed)
    with pytest.raises(ValueError):
        assign_nearest(vectors, mixed.limit(0))
    wide = spark.createDataFrame([(0, [1.0, 0.0, 0.0])], "cid int, centroid array<float>")
    with pytest.raises(Exception, match="3 components"):
        assign_nearest(vectors, wide).collect()


def test_fit_properties(spark, blobs):
    vectors, centroids = fit(spark, blobs, k=6, n_iter=3)
    report = checks.check_centroids(centroids).first()
    assert report.ok and report.k == 6
    again = fit(spark, blobs, k=6, n_iter=3)[1]
    assert collected(centroids, "cid", "centroid") == collected(again, "cid", "centroid")
    start = fit(spark, blobs, k=6, n_iter=0)[1]
    quality = [kmeans.objective(assign_nearest(vectors, c)).first().mean_similarity for c in (start, centroids)]
    assert quality[1] >= quality[0] - 1e-9


def test_block_plan_equals_broadcast_plan(spark, blobs):
    vectors = vectors_of(spark, [(i, 0, x) for i, x in enumerate(blobs)])
    start = centroid_table(spark, blobs[:5])
    one = kmeans.lloyd_step(vectors, start)
    two = kmeans.lloyd_step(vectors, start, broadcast_limit=8 * 12 * 2)
    for a, b in zip(collected(one, "cid", "centroid"), collected(two, "cid", "centroid")):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], abs=1e-12)


def test_empty_clusters_are_refilled(spark):
    v = [(1, 0), (0.98, 0.2), (0, 1), (0.2, 0.98), (0.1, 0.99)]
    vectors = vectors_of(spark, [(i, 0, x) for i, x in enumerate(v)])
    start = centroid_table(spark, [(1, 0), (0, 1), (-1, 0)])
    moved = kmeans.lloyd_step(vectors, start)
    assert moved.count() == 3
    sizes = assign_nearest(vectors, moved, keep=["idx"]).groupBy("cid").count()
    assert sizes.count() == 3, "the split cluster shares its members"


def test_fewer_points_than_clusters(spark):
    with pytest.raises(ValueError, match="2 training rows for 3 clusters"):
        fit(spark, [(1, 0), (0, 1)], k=3, n_iter=1)


def test_subsample_is_capped_and_repeatable(spark):
    vectors = spark.range(1000).select(F.col("id").alias("idx"))
    one = collected(kmeans.train_subsample(vectors, 4, 25), "idx")
    assert len(one) == 100
    assert one == collected(kmeans.train_subsample(vectors.repartition(7), 4, 25), "idx")
    assert one != collected(kmeans.train_subsample(vectors, 4, 25, seed=7), "idx")
    assert kmeans.train_subsample(vectors, 4, 250).count() == 1000
    assert kmeans.train_subsample(vectors, 4, 9999).count() == 1000

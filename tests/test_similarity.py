import numpy as np
import pytest
import __spark_entry__ as entry
from helpers import brute_scores, collected, random_unit, vectors_of

from semprune.operators import similarity
from semprune.operators.clusters import first_clusters, order_members
from semprune.operators.similarity import max_similarity


def scored(spark, rows, **options):
    vectors = vectors_of(spark, rows)
    result = max_similarity(order_members(vectors), vectors, **options)
    return {row.uid: row.sim for row in result.collect()}


def test_order_and_floor(spark):
    sims = scored(spark, [(0, 0, (1, 0)), (1, 0, (0.6, 0.8)), (2, 0, (-1, 0))])
    assert sims[0] == 0 and sims[2] == 0
    assert sims[1] == pytest.approx(0.6, abs=1e-6)


def test_first_copy_survives(spark):
    assert scored(spark, [(0, 0, (1, 0)), (1, 0, (1, 0))]) == {0: 0.0, 1: 1.0}


def test_later_copy_is_compared_with_longer_vectors_between(spark):
    assert scored(spark, [(0, 0, (1, 0)), (1, 0, (3, 0)), (2, 0, (1, 0)), (3, 0, (2, 0)), (4, 0, (1, 0))]) == {0: 0, 1: 3, 2: 3, 3: 6, 4: 3}


@pytest.mark.parametrize("tile_rows,hot_copies", [(None, 100_000), (5, 100_000), (16, 3)])
def test_vectors_of_any_length_equal_brute_force(spark, tile_rows, hot_copies):
    rng = np.random.default_rng(9)
    v = (random_unit(rng, 200, 4) * rng.integers(0, 5, (200, 1))).astype(np.float32)
    v[rng.choice(200, 120)] = v[rng.integers(0, 12, 120)]
    cids = rng.integers(0, 2, 200)
    sims = scored(spark, zip(range(200), cids, v), tile_rows=tile_rows, hot_copies=hot_copies)
    np.testing.assert_allclose([sims[i] for i in range(200)], brute_scores(cids, v), rtol=1e-12, atol=1e-12)


def test_singleton_and_separate_clusters(spark):
    assert scored(spark, [(0, 0, (1, 0)), (1, 3, (1, 0))]) == {0: 0.0, 1: 0.0}


def test_zero_vectors_score_zero(spark):
    assert scored(spark, [(0, 0, (0, 0)), (1, 0, (0, 0)), (2, 0, (1, 0))]) == {0: 0.0, 1: 0.0, 2: 0.0}


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows are copies of one vector and two thirds sit in one cluster."""
    rng = np.random.default_rng(5)
    v = random_unit(rng, 300, 8)
    v[rng.choice(300, 100, replace=False)] = v[7]
    v[290:295] = v[3:8]
    cids = np.where(rng.random(300) < 2 / 3, 0, rng.integers(1, 5, 300))
    return cids, v


@pytest.mark.parametrize("tile_rows,hot_copies", [(None, 100_000), (7, 100_000), (32, 10), (1, 1)])
def test_equals_brute_force(spark, skewed, tile_rows, hot_copies):
    cids, v = skewed
    sims = scored(spark, zip(range(len(v)), cids, v), tile_rows=tile_rows, hot_copies=hot_copies)
    assert len(sims) == len(v)
    np.testing.assert_allclose([sims[i] for i in range(len(v))], brute_scores(cids, v), atol=1e-12)


def test_tiles_grow_with_the_cluster(spark, skewed, monkeypatch):
    cids, v = skewed
    monkeypatch.setattr(similarity, "TILE_ROWS", 4)
    monkeypatch.setattr(similarity, "TILES_AIM", 8)
    for most in (64 << 20, 10 * 4 * 8):
        monkeypatch.setattr(similarity, "TILE_BYTES", most)
        sims = scored(spark, zip(range(len(v)), cids, v))
        np.testing.assert_allclose([sims[i] for i in range(len(v))], brute_scores(cids, v), atol=1e-12)


def test_rows_go_to_a_bounded_number_of_tasks(spark):
    v = random_unit(np.random.default_rng(6), 400, 8)
    vectors = vectors_of(spark, zip(range(400), [0] * 400, v))
    placed = vectors.selectExpr("cid", "idx", "idx AS ord", "1 AS copies", "idx AS pos", "400 AS n_distinct")
    sent = similarity.tile_rows_of_pairs(placed, vectors, 2).groupBy("pos").count()
    # tiles of two rows would be 200
    assert sent.agg({"count": "max"}).first()[0] <= similarity.TILES_AIM
    sims = scored(spark, zip(range(400), [0] * 400, v), tile_rows=2)
    np.testing.assert_allclose([sims[i] for i in range(400)], brute_scores([0] * 400, v), rtol=1e-12, atol=1e-12)


def test_scaled_query_keeps_copies_of_different_vectors_apart(spark, tmp_path):
    """Two copies with one uid, as any two vectors have whose ids lie 100,000 apart."""
    ids = [1, 2, 3, 100_001, 100_002, 200_003]
    v = random_unit(np.random.default_rng(7), len(ids), 4)
    rows = [(i, x.tolist(), 0) for i, x in zip(ids, v, strict=True)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    found = sorted((r.ord, r.uid, r.sim) for r in entry.q_max_similarity_scaled(spark, str(tmp_path)).collect())
    wanted = sorted((i + 100_000 * c, c, (v[k].astype(float) * (i % 7)).astype(np.float32)) for k, i in enumerate(ids) for c in range(3))
    assert [r[:2] for r in found] == [(k, w[0]) for k, w in enumerate(wanted)]
    np.testing.assert_allclose([r[2] for r in found], brute_scores([0] * len(wanted), np.array([w[2] for w in wanted])), atol=1e-6)


def test_bounds_and_first_of_cluster(spark, skewed):
    cids, v = skewed
    sims = scored(spark, zip(range(len(v)), cids, v))
    assert all(0 <= s <= 1 + 1e-6 for s in sims.values())
    for cid in set(cids):
        assert sims[int(np.flatnonzero(cids == cid)[0])] == 0


def test_independent_of_partitioning(spark, skewed):
    cids, v = skewed
    vectors = vectors_of(spark, zip(range(len(v)), cids, v))
    one = max_similarity(order_members(vectors.coalesce(1)), vectors.coalesce(1))
    many = max_similarity(order_members(vectors.repartition(13)), vectors.repartition(11), tile_rows=20)
    assert np.allclose([r[1] for r in collected(one, "uid", "sim")], [r[1] for r in collected(many, "uid", "sim")], atol=1e-12)


def test_first_clusters(spark):
    members = order_members(vectors_of(spark, [(0, 0, (1, 0)), (1, 1, (1, 0)), (2, 2, (1, 0))]))
    assert collected(first_clusters(members, 2), "cid") == [(0,), (1,)]
    assert first_clusters(members).count() == 3


def test_string_uids(spark):
    vectors = vectors_of(spark, [(0, 0, (1, 0)), (1, 0, (1, 0))])
    members = order_members(vectors.selectExpr("idx", "cid", "concat('doc', idx) as uid"))
    assert collected(max_similarity(members, vectors), "uid", "sim") == [("doc0", 0.0), ("doc1", 1.0)]

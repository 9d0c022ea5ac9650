import numpy as np
import pytest
from helpers import collected, vectors_of
from pyspark.sql import functions as F

from semprune.operators import clusters, ids, shards


def numpy_subsets(n_clusters, n_subsets):
    bounds = np.linspace(0, n_clusters, n_subsets + 1, dtype=int)
    return np.arange(n_subsets).repeat(np.diff(bounds)).tolist()


@pytest.mark.parametrize("n,s", [(10, 3), (10, 4), (119, 49), (7, 7), (5, 12), (10, 100), (1, 1), (1000, 200), (997, 31)])
def test_subsets_equal_even_spacing(spark, n, s):
    df = spark.range(n).select(F.col("id").cast("int").alias("cid"))
    found = dict(collected(shards.cluster_subsets(df, n, s), "cid", "subset"))
    assert [found[c] for c in range(n)] == numpy_subsets(n, s)


def test_offsets(spark):
    rows = spark.createDataFrame([("a",)] * 2 + [("b",)] * 3 + [("c",)], "shard string")
    assert collected(shards.shard_offsets(rows), "shard", "n", "offset") == [("a", 2, 0), ("b", 3, 2), ("c", 1, 5)]


def test_merge_shards_is_contiguous(spark):
    rows = spark.createDataFrame([("b", 0), ("a", 1), ("a", 0), ("b", 1), ("b", 2)], "shard string, idx long")
    merged = collected(shards.merge_shards(rows), "shard", "idx")
    assert merged == [("a", 0), ("a", 1), ("b", 2), ("b", 3), ("b", 4)]


def test_merge_member_lists(spark):
    rows = spark.createDataFrame([("a", 0, 0, 1), ("a", 0, 1, 2), ("b", 0, 0, 3), ("b", 1, 0, 4)], "shard string, cid int, ord long, uid long")
    assert collected(shards.merge_member_lists(rows), "cid", "ord", "uid") == [(0, 0, 1), (0, 1, 2), (0, 2, 3), (1, 0, 4)]


def test_positions_in_subset(spark):
    """Clusters (u5, u9), (), (u1) of one subset, then a second shard of one row only."""
    rows = [("a", 0, 0, 5), ("a", 0, 1, 9), ("a", 2, 0, 1), ("b", 1, 0, 4), ("b", 3, 0, 8)]
    members = spark.createDataFrame(rows, "shard string, cid int, rank long, uid long")
    placed = shards.subset_positions(members, n_clusters=4, n_subsets=1)
    assert collected(placed, "shard", "pos", "uid", "subset_idx") == [
        ("a", 0, 5, 0), ("a", 1, 9, 1), ("a", 2, 1, 2), ("b", 0, 4, 3), ("b", 1, 8, 4),
    ]
    single = shards.subset_sizes(members, 4, 4).where("subset = 3").collect()
    assert [(r.shard, r.n) for r in single] == [("b", 1)]


def test_select_members_skips_missing(spark):
    members = spark.createDataFrame([(0, 0, 1), (0, 1, 2)], "cid int, ord long, uid long")
    vectors = spark.createDataFrame([("s", 0, 2)], "shard string, idx long, uid long")
    assert collected(shards.select_members(members, vectors), "shard", "cid", "uid", "idx") == [("s", 0, 2, 0)]


def test_empty_clusters_are_listed(spark):
    members = clusters.order_members(vectors_of(spark, [(5, 2, (1, 0)), (3, 2, (1, 0)), (9, 0, (1, 0))]))
    centroids = spark.createDataFrame([(0,), (1,), (2,)], "cid int")
    assert collected(clusters.cluster_sizes(centroids, members), "cid", "n_members") == [(0, 1), (1, 0), (2, 2)]
    lists = {(r.cid, r.page): (r.inds, r.labels) for r in clusters.member_lists(centroids, members, page_rows=1).collect()}
    assert lists == {(0, 0): ([9], [9]), (1, 0): ([], []), (2, 0): ([3], [3]), (2, 1): ([5], [5])}


def test_missing_uid_fails(spark):
    members = clusters.order_members(vectors_of(spark, [(0, 0, (1, 0)), (1, 0, (1, 0))]))
    names = spark.createDataFrame([(0, "a"), (1, "b")], "idx long, uid string")
    assert collected(clusters.attach_uids(members, names), "idx", "uid") == [(0, "a"), (1, "b")]
    with pytest.raises(Exception, match="no uid for index 1"):
        clusters.attach_uids(members, names.where("idx = 0")).collect()


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_rank_by_distance(spark, limit):
    vectors = vectors_of(spark, [(0, 0, (0.9, 0)), (1, 0, (0.5, 0)), (2, 0, (0.7, 0)), (3, 1, (1, 0))])
    centroids = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0])], "cid int, centroid array<float>")
    hard = clusters.rank_in_cluster(vectors, centroids, "cosine", True, limit)
    easy = clusters.rank_in_cluster(vectors, centroids, "l2", False, limit)
    assert collected(hard.where("cid = 0"), "rank", "uid") == [(1, 1), (2, 2), (3, 0)]
    assert collected(easy.where("cid = 0"), "rank", "uid") == [(1, 0), (2, 2), (3, 1)]
    with pytest.raises(ValueError):
        clusters.rank_in_cluster(vectors, centroids, "dot")


def test_invert_ids(spark):
    mapping = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a")], "idx long, uid string")
    assert collected(ids.invert_ids(mapping), "uid", "idx") == [("a", 2), ("b", 1)]

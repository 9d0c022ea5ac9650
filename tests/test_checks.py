import pytest
from helpers import vectors_of

from semprune.operators import checks


def verdict(report):
    return all(r.ok for r in report.collect())


def test_require(spark):
    checks.require(spark.createDataFrame([(1, True)], "x int, ok boolean"), "fine")
    for bad in (False, None):
        with pytest.raises(ValueError, match="broken.*'x': 2"):
            checks.require(spark.createDataFrame([(1, True), (2, bad)], "x int, ok boolean"), "broken")


def test_counts(spark):
    assert verdict(checks.check_counts(spark.range(3).toDF("idx"), spark.range(3).toDF("idx")))
    row = checks.check_counts(spark.range(3).toDF("idx"), spark.range(1, 6).toDF("idx")).first()
    assert (row.n_ids, row.n_vectors, row.ids_without_vector, row.vectors_without_id, row.ok) == (3, 5, 1, 3, False)


def shards(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "shard string")


def test_shards(spark):
    assert verdict(checks.check_shards(shards(spark, "a", "b", "a"), shards(spark, "a", "a", "b")))
    assert not verdict(checks.check_shards(shards(spark, "a", "b"), shards(spark, "a")))
    assert not verdict(checks.check_shards(shards(spark, "a", "a"), shards(spark, "a")))


def test_shard_kinds(spark):
    assert verdict(checks.check_shard_kinds(vectors=shards(spark, "a"), ids=shards(spark, "a")))
    rows = checks.check_shard_kinds(vectors=shards(spark, "a"), ids=shards(spark, "a", "b"), clusters=shards(spark, "a"))
    assert {r.shard: (r.missing, r.ok) for r in rows.collect()} == {"a": ("", True), "b": ("clusters,vectors", False)}


def test_cluster_counts(spark):
    schema = "shard string, cid int"
    assert verdict(checks.check_cluster_counts(spark.createDataFrame([("a", 0), ("a", 1), ("b", 1)], schema)))
    assert not verdict(checks.check_cluster_counts(spark.createDataFrame([("a", 0), ("a", 1), ("b", 2)], schema)))


def test_bijection(spark):
    schema = "idx long, uid string"
    good = spark.createDataFrame([(0, "a"), (1, "b")], schema)
    assert verdict(checks.check_bijection(good, good))
    for pairs, members in (
        ([(0, "a"), (0, "b")], [(0, "a")]),
        ([(0, "a"), (1, "a")], [(0, "a")]),
        ([(0, "a"), (1, "b")], [(0, "b")]),
    ):
        assert not verdict(checks.check_bijection(spark.createDataFrame(pairs, schema), spark.createDataFrame(members, schema)))


def test_unique(spark):
    assert verdict(checks.check_unique(spark.range(3), "id"))
    assert checks.check_unique(spark.range(3).union(spark.range(2)), "id").first().asDict() == {"n_repeated": 2, "ok": False}


def test_labels(spark):
    members = spark.createDataFrame([(0, 0, 5), (0, 1, 6), (1, 0, 7)], "cid int, idx long, uid long")
    ids = spark.range(3).toDF("idx")
    assert verdict(checks.check_member_labels(members, ids))
    assert not verdict(checks.check_member_labels(members, spark.range(4).toDF("idx")))
    scores = spark.createDataFrame([(0, 0.1), (0, 0.2), (1, 0.0)], "cid int, sim double")
    assert verdict(checks.check_similarity_labels(members, scores))
    assert not verdict(checks.check_similarity_labels(members, scores.where("cid = 0")))


@pytest.mark.parametrize(
    "rows,ok",
    [
        ([(0, [1.0, 0.0]), (1, [0.6, 0.8])], True),
        ([(0, [1.0, 0.0]), (2, [0.6, 0.8])], False),
        ([(0, [1.0, 0.0]), (0, [0.6, 0.8])], False),
        ([(0, [1.0, 0.0]), (1, [1.0])], False),
        ([(0, [1.0, 0.0]), (1, [0.6, 0.9])], False),
    ],
)
def test_centroids(spark, rows, ok):
    assert verdict(checks.check_centroids(spark.createDataFrame(rows, "cid int, centroid array<float>"))) is ok


def test_vectors(spark):
    good = vectors_of(spark, [(0, 0, (0, 1)), (1, 0, (0, 0))])
    assert checks.check_vectors(good).first().asDict() == {"n_vectors": 2, "n_zero": 1, "n_nan": 0, "n_not_unit": 0, "ok": True}
    bad = vectors_of(spark, [(0, 0, (float("nan"), 1)), (1, 0, (2, 0))])
    assert checks.check_vectors(bad).first().asDict() == {"n_vectors": 2, "n_zero": 0, "n_nan": 1, "n_not_unit": 1, "ok": False}

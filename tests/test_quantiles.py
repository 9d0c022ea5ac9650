import numpy as np
import pytest
from pyspark.sql import functions as F

from semprune.operators import merge, prune, quantiles


def table(spark, values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "uid long, sim double")


def test_hand_computed(spark):
    found = {r.q: r.value for r in quantiles.quantiles(table(spark, [0, 0, 0.6]), [0.5, 0.75, 0.9]).collect()}
    assert found[0.5] == 0
    assert found[0.75] == pytest.approx(0.3)
    assert found[0.9] == pytest.approx(0.48)


@pytest.mark.parametrize("n", [1, 2, 19, 1000])
def test_equals_numpy(spark, n):
    rng = np.random.default_rng(n)
    values = np.where(rng.random(n) < 0.4, 0.0, rng.random(n) * 1.2 - 0.1)
    found = {r.q: r.value for r in quantiles.quantiles(table(spark, values)).collect()}
    assert sorted(found) == quantiles.DEFAULT_QUANTILES
    for q, value in found.items():
        assert value == pytest.approx(np.quantile(values, q), abs=1e-12)


def test_all_values_in_one_cell(spark):
    values = 0.5 + np.arange(50) * 1e-9
    found = {r.q: r.value for r in quantiles.quantiles(table(spark, values), [0.0, 0.3, 1.0]).collect()}
    for q, value in found.items():
        assert value == pytest.approx(np.quantile(values, q), abs=1e-15)


@pytest.mark.parametrize("group", [None, ["g"]])
def test_crowded_cells_are_refined(spark, monkeypatch, group):
    """Copies score within rounding of 1, and values lie far outside [0, 1]."""
    monkeypatch.setattr(quantiles, "ORDER_ROWS", 20)
    monkeypatch.setattr(quantiles, "CELLS", 16)
    rng = np.random.default_rng(4)
    values = np.concatenate([1 + rng.normal(size=300) * 1e-7, rng.random(100), [-1e9, 1e9], np.full(150, 0.25)])
    scores = table(spark, values).withColumn("g", F.lit("a"))
    points = [0.0, 0.01, 0.3, 0.5, 0.77, 0.99, 1.0]
    found = {r.q: r.value for r in quantiles.quantiles(scores, points, group=group).collect()}
    for q in points:
        assert found[q] == pytest.approx(np.quantile(values, q), rel=1e-14)


def test_no_scores(spark):
    assert quantiles.quantiles(table(spark, []).where("false")).count() == 0


def test_per_shard(spark):
    scores = table(spark, np.linspace(0, 1, 30)).withColumn("shard", F.when(F.col("uid") < 20, "a").otherwise("b"))
    found = {(r.shard, r.q): (r.n, r.value) for r in quantiles.shard_quantiles(scores, [0.5]).collect()}
    assert found[("a", 0.5)] == (20, pytest.approx(np.median(np.linspace(0, 1, 30)[:20])))
    assert found[("b", 0.5)] == (10, pytest.approx(np.median(np.linspace(0, 1, 30)[20:])))


def test_merged(spark):
    rows = [("A", 2, 0.5, 0.2), ("B", 3, 0.5, 0.4)]
    merged = quantiles.merge_quantiles(spark.createDataFrame(rows, "shard string, n long, q double, value double"))
    assert merged.first().value == pytest.approx(0.32)


def test_unknown_point_lists_known(spark):
    known = spark.createDataFrame([(q, 0.1) for q in quantiles.DEFAULT_QUANTILES], "q double, value double")
    assert quantiles.threshold_at(known, 0.15) == 0.1
    with pytest.raises(KeyError, match="0.77.*0.05, 0.1, 0.15.*0.95"):
        quantiles.threshold_at(known, 0.77)


def test_strict_threshold(spark):
    scores = table(spark, [0, 0, 0.6])
    points = quantiles.quantiles(scores, [0.5, 0.75])
    flags = {r.uid: (r.keep_0pt5, r.keep_0pt75) for r in prune.keep_flags(scores, points, [0.5, 0.75]).collect()}
    assert flags == {0: (False, True), 1: (False, True), 2: (False, False)}


def test_kept_set_grows_with_the_fraction(spark):
    scores = table(spark, np.random.default_rng(1).random(200))
    points = quantiles.quantiles(scores)
    sizes = [scores.where(F.col("sim") < quantiles.threshold_at(points, q)).count() for q in (0.1, 0.4, 0.9)]
    assert sizes == sorted(sizes) and sizes[0] > 0


SHARDS = "shard string, ord long, uid long, sim double"


def test_conflict_rules(spark):
    scores = spark.createDataFrame([("A", 0, 7, 0.9), ("B", 0, 7, 0.1), ("B", 1, 8, 0.5)], SHARDS)
    assert {r.uid: r.sim for r in merge.merge_similarities(scores).collect()} == {7: 0.1, 8: 0.5}
    assert {r.uid: r.sim for r in merge.resolve_duplicates(scores, "max").collect()} == {7: 0.9, 8: 0.5}
    with pytest.raises(Exception, match="repeated uid 7"):
        merge.resolve_duplicates(scores, "error").collect()
    single = merge.resolve_duplicates(scores.where("uid = 8"), "error").collect()
    assert [(r.uid, r.sim) for r in single] == [(8, 0.5)]
    with pytest.raises(ValueError):
        merge.resolve_duplicates(scores, "first")


def test_last_uses_the_position_inside_a_shard(spark):
    scores = spark.createDataFrame([("A", 3, 7, 0.3), ("A", 1, 7, 0.1)], SHARDS)
    assert merge.merge_similarities(scores).first().sim == 0.3


@pytest.mark.parametrize("sims,kept,counts", [((0.9, 0.1), [7], (1, 1)), ((0.1, 0.2), [7], (2, 0)), ((0.9, 0.5), [], (0, 2))])
def test_kept_set_and_counts(spark, sims, kept, counts):
    scores = spark.createDataFrame([("A", 0, 7, sims[0]), ("B", 0, 7, sims[1])], SHARDS)
    assert [r.uid for r in merge.kept_set(scores, 0.5).collect()] == kept
    row = merge.kept_counts(scores, 0.5).first()
    assert (row.kept, row.removed) == counts
    assert row.kept_share == counts[0] / 2


def test_counts_of_nothing(spark):
    row = merge.kept_counts(spark.createDataFrame([], SHARDS), 0.5).first()
    assert (row.kept, row.removed, row.kept_share) == (0, 0, None)

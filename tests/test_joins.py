import pytest
from helpers import collected

from semprune.operators import joins


@pytest.mark.parametrize("small", [0, 10])
def test_small_and_large_tables_join_alike(spark, monkeypatch, small):
    monkeypatch.setattr(joins, "SMALL_ROWS", small)
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    counts = spark.createDataFrame([("a", 10), ("b", 20), ("c", 30)], "k string, n int")
    joined = joins.join_counts(rows, counts, ["k"])
    assert collected(joined, "k", "v", "n") == [("a", 1, 10), ("a", 2, 10), ("b", 3, 20)]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert ("broadcast" in plan) == (small > 0)

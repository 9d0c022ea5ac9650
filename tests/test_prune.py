import pytest
from helpers import collected
from pyspark.sql import functions as F

from semprune.operators import prune

DOCS = "idx long, uid long, text string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(0, 10, "a" * 10, "x"), (1, 11, "b" * 99, "x"), (2, 12, "c" * 50, "y"), (3, None, "d", "y"), (4, 14, "e" * 40, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame([(10, 0.1), (11, 0.9), (14, 0.2)], "uid long, sim double")


def test_totals(docs, scores):
    judged = prune.judge(docs, prune.keep_map(scores, 0.5), "uid", "source")
    row = prune.totals(judged).first().asDict()
    assert row == {"n_samples": 2, "mean_length": 25.0, "found": 3, "not_found": 1, "no_uid": 1, "removed": 1}
    assert collected(prune.source_totals(judged), "source", "n_samples", "mean_length") == [("x", 1, 10.0)]


def test_missing_source_column(docs, scores):
    judged = prune.judge(docs, prune.keep_map(scores, 0.5), "uid", "no_such_column")
    assert prune.source_totals(judged).count() == 0


def test_documents_keep_all_columns(docs, scores):
    kept = prune.prune_documents(docs, prune.keep_map(scores, 0.5), "uid")
    assert kept.columns == docs.columns
    assert collected(kept, "uid") == [(10,), (14,)]


def test_boolean_flags_need_no_threshold(spark, docs):
    flags = spark.createDataFrame([(10, False), (11, True)], "uid long, sim boolean")
    assert collected(prune.prune_documents(docs, prune.keep_map(flags), "uid"), "uid") == [(11,)]
    with pytest.raises(ValueError):
        prune.keep_map(spark.createDataFrame([(10, 0.5)], "uid long, sim double"))


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_text_similarity(spark, docs, kind):
    stored = spark.createDataFrame([(10, "0.25"), (11, "x"), (12, "0.3")], "uid long, sim string")
    stored = stored.withColumn("sim", F.col("sim").cast(kind))
    judged = prune.judge(docs, prune.keep_map(stored, 0.3), "uid")
    found = {r.uid: r.status for r in judged.collect()}
    assert found == {10: "kept", 11: "not_found", 12: "removed", 14: "not_found", None: "no_uid"}


def test_set_form(spark, docs):
    kept = spark.createDataFrame([(10,), (12,), (77,)], "uid long")
    assert collected(prune.prune_to_set(docs, kept, "uid"), "uid") == [(10,), (12,)]
    assert collected(prune.outside_set(docs, kept, "uid"), "uid") == [(11,), (14,)]
    row = prune.set_totals(docs, kept, "uid").first().asDict()
    assert row == {"n_samples": 2, "mean_length": 30.0, "found": 4, "not_found": 2, "no_uid": 1, "removed": 2}


def test_string_uids_are_joined(spark, docs):
    named = docs.withColumn("name", F.concat(F.lit("n"), F.col("uid").cast("string")))
    kept = spark.createDataFrame([("n10",)], "uid string")
    assert collected(prune.prune_to_set(named, kept, "name"), "uid") == [(10,)]
    assert collected(prune.outside_set(named, kept, "name"), "uid") == [(11,), (12,), (14,)]


def test_bitmap_equals_join(spark, monkeypatch):
    ids = [-70000, -32768, -1, 0, 1, 7, 8, 32767, 32768, 32769, 65536, 10**12]
    docs = spark.createDataFrame([(i, i, "t", "s") for i in ids], DOCS)
    kept = docs.select("uid").where(F.col("uid").isin(ids[::2]))
    by_bitmap = prune.prune_to_set(docs, kept, "uid")
    monkeypatch.setattr(prune, "BITMAP_LIMIT", 0)
    by_join = prune.prune_to_set(docs, kept, "uid")
    assert collected(by_bitmap, "uid") == collected(by_join, "uid") == sorted((i,) for i in ids[::2])
    assert collected(prune.outside_set(docs, kept, "uid"), "uid") == sorted((i,) for i in ids[1::2])


def test_uid_falls_back_to_the_index(docs):
    assert collected(docs.select(prune.uid_column(docs, "nothing").alias("u")), "u") == [(i,) for i in range(5)]
    assert docs.select(prune.uid_column(docs)).columns == ["idx"]

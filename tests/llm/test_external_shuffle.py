from collections import Counter

from edge import documents, no_documents
from pyspark.sql import functions as F

from semprune.llm import external_shuffle as es


def shards_of(docs, n=8, **options):
    return es.shuffle_into_shards(docs, n, es.record_bytes(F.col("text")), **options)


def check(rows, n_rows, n):
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(s, 0) for s in range(n)]
    assert sum(sizes) == n_rows and max(sizes) - min(sizes) <= 1
    for s in range(n):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_all_rows_once_in_even_shards(spark):
    docs = documents(spark).repartition(3)
    for n, size in ((8, 1 << 24), (3, 100_000), (1, 50)):
        rows = shards_of(docs, n, bucket_bytes=size).collect()
        check(rows, docs.count(), n)
        key = lambda r: (r.doc_id, r.text, r["a.b"], r.quality)
        assert Counter(map(key, rows)) == Counter(map(key, docs.collect()))


def test_hot_text_spreads(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    rows = shards_of(docs, 8, bucket_bytes=2000).collect()
    check(rows, 6000, 8)
    same = Counter(r.shard for r in rows if r.text == "same")
    assert len(same) == 8 and max(same.values()) < 1.35 * 250


def test_order_is_random_and_seeded(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    order = lambda seed: [r.doc_id for r in shards_of(docs, 1, seed=seed).orderBy("slot").collect()]
    first = order(1)
    assert first == order(1) != order(2)
    neighbours = sum(abs(a - b) == 1 for a, b in zip(first, first[1:], strict=False))
    assert neighbours < 20


def test_no_rows(spark):
    assert shards_of(no_documents(spark)).count() == 0

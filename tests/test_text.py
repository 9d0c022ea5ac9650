import numpy as np
import pyarrow as pa
import pytest
from helpers import SF, collected
from pyspark.sql import functions as F

from semprune.functions.vectors import is_zero_vector, l2_normalize
from semprune.operators import chunk, embed


def docs_of(spark, *texts):
    return spark.createDataFrame([(i, f"d{i}", t) for i, t in enumerate(texts)], "idx long, name string, text string")


SEVEN = "a b c  d\te\nf g"


def sizes(df):
    return [r.n_tokens for r in df.orderBy("idx", "chunk").collect()]


def test_chunk_sizes(spark):
    assert sizes(chunk.chunk_documents(docs_of(spark, SEVEN), 3)) == [3, 3, 1]


def test_instruction_in_every_chunk(spark):
    rows = chunk.chunk_documents(docs_of(spark, SEVEN), 3, "query: ").orderBy("chunk").collect()
    assert [len(r.tokens) - 1 for r in rows] == [2, 2, 2, 1]
    assert {r.tokens[0] for r in rows} == {"query:"}


def test_special_tokens_frame_the_instruction(spark):
    tokenizer = chunk.Tokenizer(start=("[CLS]",), end=("[SEP]",))
    rows = chunk.chunk_documents(docs_of(spark, SEVEN), 6, "query: ", tokenizer).orderBy("chunk").collect()
    assert rows[0].tokens == ["[CLS]", "query:", "a", "b", "c", "[SEP]"]
    assert [len(r.tokens) for r in rows] == [6, 6, 4]


def test_empty_text_keeps_a_chunk(spark):
    docs = docs_of(spark, "", "  \n", None)
    assert [(r.chunk, r.n_tokens) for r in chunk.chunk_documents(docs, 3).collect()] == [(0, 0)] * 3
    assert chunk.chunk_characters(docs, 5).count() == 3
    assert embed.embed_documents(docs, embed.HashedWords(4), 3).where("n_chunks = 1").count() == 3


def test_no_room_for_text(spark):
    with pytest.raises(ValueError):
        chunk.chunk_documents(docs_of(spark, SEVEN), 1, "query: ")


def test_whole_text_survives(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("idx", F.col("doc_id"))
    cut = chunk.chunk_documents(docs, 50)
    rebuilt = {}
    for r in cut.orderBy("idx", "chunk").collect():
        rebuilt.setdefault(r.idx, []).extend(r.tokens)
    for r in docs.select("idx", "text").collect():
        assert rebuilt[r.idx] == r.text.split()


def test_plugin_tokenizer_and_uid(spark):
    upper = chunk.Tokenizer(load=lambda: lambda texts: [t.upper().split() for t in texts])
    rows = chunk.chunk_documents(docs_of(spark, SEVEN), 4, "go", upper, uid_key="name").orderBy("chunk").collect()
    assert [r.tokens for r in rows] == [["GO", "A", "B", "C"], ["GO", "D", "E", "F"], ["GO", "G"]]
    assert {r.uid for r in rows} == {"d0"}


def test_plugin_tokenizer_gets_few_characters_at_once(spark):
    told = chunk.Tokenizer(load=lambda: lambda texts: [[t[0], str(sum(map(len, texts)))] for t in texts])
    docs = docs_of(spark, *[c * 400_000 for c in "abcdefg"], "h" * (chunk.TEXT_BATCH + 1), "i").coalesce(1)
    rows = {r.idx: r.tokens for r in chunk.chunk_documents(docs, 2, tokenizer=told).collect()}
    assert [rows[i][0] for i in range(9)] == list("abcdefghi")
    assert rows[7][1] == str(chunk.TEXT_BATCH + 1)
    assert all(int(rows[i][1]) <= chunk.TEXT_BATCH for i in range(9) if i != 7)


@pytest.mark.parametrize("sizes,runs", [([], [(0, 0)]), ([5, 1, 1, 9, 0, 3], [(0, 1), (1, 3), (3, 4), (4, 6)]), ([2, 2, 2], [(0, 2), (2, 3)]), ([0, 0], [(0, 2)])])
def test_runs_within(sizes, runs):
    assert [(r.start, r.stop) for r in chunk.runs_within(np.array(sizes, np.int64), 4)] == runs


def test_remembered_words_are_bounded():
    model = embed.HashedWords(16)
    model.load()
    words = [pa.array([[f"w{k}-{i}" for i in range(50_000)]]) for k in range(6)]
    first = model.embed(words[0])
    for w in words[1:]:
        model.embed(w)
        assert len(model._known) <= 1 << 17
    assert (model.embed(words[0]) == first).all()


def test_character_chunks(spark):
    docs = docs_of(spark, "abc\ndefg", "", "é😀x")
    pieces = chunk.chunk_characters(docs, 2)
    assert collected(pieces, "uid", "chunk", "piece") == [
        (0, 0, "ab"), (0, 1, "c\n"), (0, 2, "de"), (0, 3, "fg"), (1, 0, ""), (2, 0, "é😀"), (2, 1, "x"),
    ]


def test_normalize(spark):
    df = spark.createDataFrame([([0.5, 0.5],), ([0.0, 0.0],), ([0.0, 1.0],)], "v array<float>")
    rows = df.select(l2_normalize(F.col("v")).alias("u"), is_zero_vector(F.col("v")).alias("zero")).collect()
    assert rows[0].u == pytest.approx([0.707107, 0.707107], abs=1e-6)
    assert rows[1].u == [0, 0] and [r.zero for r in rows] == [False, True, False]


def test_mean_and_post_processing(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [3.0, 0.0])], "uid long, embedding array<double>")
    assert {r.uid: r.embedding for r in embed.document_means(vectors).collect()} == {1: [0.5, 0.5], 2: [3.0, 0.0]}
    unit = {r.uid: r.embedding for r in embed.post_process(vectors).collect()}
    assert unit[1] == pytest.approx([0.707107, 0.707107], abs=1e-6) and unit[2] == [1, 0]


def test_masked_mean_ignores_padding():
    states = np.array([[[1.0, 2.0], [3.0, 4.0], [100.0, 100.0]]])
    assert embed.masked_mean(states, np.array([[1, 1, 0]])).tolist() == [[2.0, 3.0]]


@pytest.mark.parametrize("batch", [1, 3, 640])
@pytest.mark.parametrize("arrow_batch", [2, 10_000])
def test_documents_across_batches(spark, batch, arrow_batch):
    """Running sums over batch borders equal the shuffled mean of all chunk vectors."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", arrow_batch)
    try:
        docs = docs_of(spark, SEVEN * 3, "", "x y", SEVEN, "z " * 40).repartition(2)
        model = embed.HashedWords(16)
        vectors = embed.embed_documents(docs, model, 4, uid_key="name", batch_size=batch).collect()
        chunks = embed.chunk_vectors(chunk.chunk_documents(docs, 4, uid_key="name"), model, batch)
        wanted = {r.uid: r.embedding for r in embed.post_process(chunks).collect()}
        counts = {r.uid: r.n_chunks for r in chunk.chunk_counts(chunks).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(vectors) == 5
    for r in vectors:
        assert r.embedding == pytest.approx(wanted[r.uid], abs=1e-6)
        assert r.n_chunks == counts[r.uid]
    assert collected(embed.zero_vectors(spark.createDataFrame(vectors)), "uid") == [("d1",)]


def test_plugin_model(spark):
    """Token count and a constant, computed by a model loaded once per task."""

    class Lengths(embed.Embedder):
        dim = 2

        def load(self):
            self.constant = 3.0

        def embed(self, features: pa.ListArray):
            return np.array([[len(tokens), self.constant] for tokens in features.to_pylist()], dtype=float)

    row = embed.embed_documents(docs_of(spark, "a b c d"), Lengths(), 4).first()
    assert row.embedding == pytest.approx([0.8, 0.6])

import numpy as np
import __spark_entry__ as entry
import pytest
from helpers import SF, collected, random_unit, vectors_of
from pyspark.sql import functions as F

from semprune import session
from semprune.functions import names
from semprune.sources import matrix, sinks, tables


@pytest.mark.parametrize(
    "n_bytes,n,dim,shape",
    [(48, None, 3, (4, 3)), (48, 4, None, (4, 3)), (48, 4, 3, (4, 3)), (0, None, 3, (0, 3))],
)
def test_matrix_shape(n_bytes, n, dim, shape):
    assert matrix.matrix_shape(n_bytes, n, dim) == shape


@pytest.mark.parametrize("n_bytes,n,dim", [(48, None, None), (48, None, 5), (47, None, 3), (48, 5, 3), (48, 0, None)])
def test_bad_matrix_shape(n_bytes, n, dim):
    with pytest.raises(ValueError):
        matrix.matrix_shape(n_bytes, n, dim)


def test_read_file_by_ranges(spark, tmp_path):
    data = random_unit(np.random.default_rng(0), 37, 5)
    data.tofile(tmp_path / "m.npy")
    spark.dataSource.register(matrix.RawMatrixSource)
    reader = spark.read.format("raw_matrix").option("path", str(tmp_path / "m.npy")).option("n_samples", 37)
    df = reader.option("split_bytes", 200).load()
    assert df.rdd.getNumPartitions() == 4
    rows = df.orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(37)) and {r.shard for r in rows} == {"m.npy"}
    np.testing.assert_array_equal(np.array([r.embedding for r in rows], dtype=np.float32), data)


def test_matrix_round_trip(spark, tmp_path):
    data = random_unit(np.random.default_rng(0), 60, 4)
    vectors = vectors_of(spark, [(i, 0, x) for i, x in enumerate(data)])
    matrix.write_matrix(vectors.repartition(5), str(tmp_path / "out"))
    from semprune.operators.shards import merge_shards

    rows = merge_shards(matrix.read_matrix(spark, str(tmp_path / "out"), dim=4)).orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(60))
    np.testing.assert_array_equal(np.array([r.embedding for r in rows], dtype=np.float32), data)


def test_missing_matrix(spark, tmp_path):
    with pytest.raises(Exception, match="nowhere"):
        matrix.read_matrix(spark, str(tmp_path / "nowhere"), dim=4).count()


def test_split_and_index(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("split", F.when(F.col("doc_id") % 3 == 0, "val").otherwise("train"))
    docs.write.partitionBy("split").parquet(str(tmp_path / "docs"))
    val = tables.read_documents(spark, str(tmp_path / "docs"), split="val", index_key="doc_id")
    assert val.count() == docs.where("split = 'val'").count()
    assert val.where("idx <> doc_id").count() == 0
    numbered = tables.read_documents(spark, str(tmp_path / "docs"))
    assert collected(numbered, "idx") == [(i,) for i in range(docs.count())]
    one_split = tables.read_documents(spark, str(tmp_path / "docs"), split="val")
    assert collected(one_split, "idx") == [(i,) for i in range(val.count())]


@pytest.mark.parametrize("file_format,split", [("parquet", None), ("parquet", "even"), ("json", None)])
def test_positions_without_an_index(spark, tmp_path, file_format, split):
    rows = spark.range(60).select("id", F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("split"))
    rows.repartition(4).write.format(file_format).save(str(tmp_path / "rows"))
    first = tables.read_documents(spark, str(tmp_path / "rows"), file_format, split)
    again = tables.read_documents(spark, str(tmp_path / "rows"), file_format, split)
    assert collected(first, "idx") == [(i,) for i in range(30 if split else 60)]
    assert collected(first, "idx", "id") == collected(again, "idx", "id")


def test_pairing_needs_complete_shards(spark, tmp_path):
    vectors = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "idx long, embedding array<float>")
    ids = spark.createDataFrame([(0, "a"), (1, "b")], "idx long, uid string")
    for shard in ("s0", "s1"):
        vectors.write.parquet(str(tmp_path / "vectors" / shard))
        ids.write.parquet(str(tmp_path / "ids" / shard))
    read = [tables.read_shards(spark, str(tmp_path / kind)) for kind in ("vectors", "ids")]
    assert collected(tables.pair_shards(*read), "shard", "idx", "uid") == [
        ("s0", 0, "a"), ("s0", 1, "b"), ("s1", 0, "a"), ("s1", 1, "b"),
    ]
    tables.complete_shards(vectors=read[0], ids=read[1])
    with pytest.raises(ValueError, match="s1"):
        tables.pair_shards(read[0], read[1].where("shard = 's0'"))
    with pytest.raises(ValueError, match="s1"):
        tables.complete_shards(vectors=read[0], ids=read[1].where("shard = 's0'"))
    assert tables.read_shards(spark, str(tmp_path / "ids"), by="file").select("shard").distinct().count() >= 2


def test_subset_directories(spark, tmp_path):
    placed = spark.createDataFrame([(0, 1, 0, 7), (11, 4, 0, 8), (11, 4, 1, 9)], "subset int, cid int, subset_idx long, uid long")
    path = str(tmp_path / "subsets")
    sinks.write_subsets(placed, path, 120)
    assert sorted(p.name for p in (tmp_path / "subsets").glob("subset=*")) == ["subset=000", "subset=011"]
    assert collected(sinks.read_subset(spark, path, 11, 120), "uid") == [(8,), (9,)]


def test_written_like_the_source(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    target = sinks.write_like(docs.withColumn("extra", F.lit(1)), str(tmp_path / "out"), docs.schema, "train", compression="zstd", max_records_per_file=30)
    assert target.endswith("/train")
    again = spark.read.parquet(target)
    assert again.columns == docs.columns and again.count() == docs.count()
    assert len(list((tmp_path / "out" / "train").glob("*.zstd.parquet"))) == -(-docs.count() // 30)


def test_names(spark):
    assert names.keep_name(0.8) == "keep_0pt8" and names.kept_set_name(0.05) == "similarities_0pt05"
    label = spark.range(1).select(names.subset_label(F.lit(7), 200)).first()[0]
    assert label == "007"


def test_inputs_are_removed_only_after_commit(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(RuntimeError):
        sinks.remove_inputs(spark, [str(tmp_path / "in")], [str(tmp_path / "out")])
    assert (tmp_path / "in").exists()
    spark.range(3).write.parquet(str(tmp_path / "out"))
    spark.range(3).write.parquet(str(tmp_path / "in" / "below"))
    for outputs in (["out", "missing"], ["out", "in/below"]):
        with pytest.raises(RuntimeError):
            sinks.remove_inputs(spark, [str(tmp_path / "in")], [str(tmp_path / o) for o in outputs])
    assert (tmp_path / "in").exists()
    sinks.remove_inputs(spark, [str(tmp_path / "in")], [str(tmp_path / "out")])
    assert not (tmp_path / "in").exists()


def test_scratch_uses_the_cluster_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(root)
    kept = session.materialize(spark.range(5), "numbers")
    assert all(f.split("file:")[-1].lstrip("/").startswith(root.lstrip("/")) for f in kept.inputFiles())


def test_files_of_the_json_query_grow_in_number(spark, tmp_path, monkeypatch):
    rows = [(i, "x" * (50 + i), "en" if i % 3 else "de") for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(entry, "FILE_BYTES", 6_000, raising=False)
    monkeypatch.setattr(entry, "scratch_path", lambda _, name: str(tmp_path / name))
    found = collected(entry.q_read_documents_index(spark, str(tmp_path)), "idx", "doc_id", "length")
    assert found == [(k, i, 50 + i) for k, i in enumerate(i for i in range(300) if i % 3)]
    assert len(list((tmp_path / "json-documents").glob("part-*"))) == 10

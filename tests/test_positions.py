import numpy as np
import pytest
from pyspark.sql import functions as F

from semprune.operators.positions import number_rows, position_by_key, position_by_order


@pytest.mark.parametrize("width", [1, 7, 1 << 18])
def test_position_by_key(spark, width):
    df = spark.range(200).select((F.col("id") * 3).alias("key"), (F.col("id") % 7 < 5).alias("g"))
    rows = position_by_key(df, ["g"], "key", "pos", size_out="n", width=width).collect()
    for g in (True, False):
        mine = sorted((r.key, r.pos, r.n) for r in rows if r.g == g)
        assert [p for _, p, _ in mine] == list(range(len(mine)))
        assert {n for _, _, n in mine} == {len(mine)}


def test_position_without_group(spark):
    rows = position_by_key(spark.range(50).selectExpr("id * 2 as key"), [], "key", "pos", width=8).collect()
    assert sorted((r.key, r.pos) for r in rows) == [(2 * i, i) for i in range(50)]


def test_position_by_order_with_hot_group_and_ties(spark):
    df = spark.range(500).select(
        F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 3).alias("g"),
        (F.hash("id") % 5).alias("value"),
        "id",
    )
    rows = position_by_order(df, ["g"], [F.col("value").desc(), F.col("id").asc()], "pos").collect()
    assert len(rows) == 500
    for g in {r.g for r in rows}:
        mine = sorted((r for r in rows if r.g == g), key=lambda r: (-r.value, r.id))
        assert [r.pos for r in mine] == list(range(len(mine)))


@pytest.mark.parametrize("group", [["g"], []])
def test_hash_keys_and_a_hot_group(spark, group):
    df = spark.range(600).select(F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 3).alias("g"), F.xxhash64("id").alias("key"))
    rows = position_by_key(df, group, "key", "pos", size_out="n").collect()
    assert len(rows) == 600
    for g in {r.g for r in rows} if group else {None}:
        mine = sorted((r for r in rows if not group or r.g == g), key=lambda r: r.key)
        assert [r.pos for r in mine] == list(range(len(mine))) and {r.n for r in mine} == {len(mine)}


def test_number_rows_is_contiguous(spark, tmp_path):
    spark.range(100, numPartitions=7).withColumnRenamed("id", "value").write.parquet(str(tmp_path / "rows"))
    rows = number_rows(spark.read.parquet(str(tmp_path / "rows"))).collect()
    assert sorted(r.idx for r in rows) == list(range(100))
    assert np.array_equal([r.value for r in sorted(rows, key=lambda r: r.idx)], np.arange(100))


def test_numbers_do_not_depend_on_how_files_are_split(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(2000, numPartitions=3).select(F.col("id"), F.repeat(F.lit("x"), 50).alias("pad")).write.json(path)
    found = []
    for size in ("2000", "100m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            scan = spark.read.schema("id long, pad string").json(path)
            rows = number_rows(scan.where("id % 3 <> 1")).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        found.append({r.id: r.idx for r in rows})
    assert found[0] == found[1] and sorted(found[0].values()) == list(range(len(found[0])))

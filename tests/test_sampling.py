"""Skew-proof ranking equals the window definition; split sizes are exact."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.operators import sampling as S


def test_hash_rank_equals_window_rank(spark):
    df = spark.range(0, 3000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"))
    got = S.hash_rank(df, ["g"], "k", "s1", out="r")
    w = Window.partitionBy("g").orderBy(S.order_hash("k", "s1"), "k")
    want = df.withColumn("r", F.row_number().over(w) - 1)
    assert got.select("k", "g", "r").exceptAll(want.select("k", "g", "r")).count() == 0
    assert got.count() == 3000


def test_hot_group_split_sizes(spark):
    # one class holds most rows: sizes must still be floor(0.7 n)
    df = spark.range(0, 5000).select(F.col("id").alias("k"),
                                     F.when(F.col("id") < 4000, "hot").otherwise(F.lit("cold")).alias("label"))
    sp = S.train_test_split(df, "label", "k", "7")
    counts = {(r.label, r.set): r["count"] for r in sp.groupBy("label", "set").count().collect()}
    assert counts[("hot", "train")] == math.floor(4000 * 0.7)
    assert counts[("cold", "train")] == math.floor(1000 * 0.7)
    # indices restart at 0 in each split and are dense
    idx = sp.groupBy("label", "set").agg(F.min("idx").alias("lo"), F.max("idx").alias("hi"), F.count("*").alias("n"))
    for r in idx.collect():
        assert r.lo == 0 and r.hi == r.n - 1


def test_first_k_and_nth(spark):
    df = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(20)], "id long, g string")
    top = S.first_k_per_group(df, "g", ["id"], 3).collect()
    assert sorted((r.g, r.id) for r in top) == [("a", 1), ("a", 3), ("a", 5), ("b", 0), ("b", 2), ("b", 4)]
    nth = {r.g: r.id for r in S.nth_in_group(df, "g", ["id"], 2).collect()}
    assert nth == {"a": 5, "b": 4}


def test_batches_have_at_most_batch_size(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("k"))
    b = S.add_batches(df, "k", batch_size=100)
    sizes = [r["count"] for r in b.groupBy("bucket", "batch_id").count().collect()]
    assert max(sizes) <= 100 and sum(sizes) == 1000


def test_bucketed_rank_descending_in_hot_group(spark):
    from pyspark.sql import Window

    df = spark.range(0, 5000).select((F.col("id") % 2).alias("g"), F.col("id").alias("t"))
    got = S.bucketed_rank(df, ["g"], [F.col("t").desc()], F.floor(-F.col("t") / 64), out="r")
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.col("t").desc())) - 1)
    assert got.select("g", "t", "r").exceptAll(want.select("g", "t", "r")).count() == 0

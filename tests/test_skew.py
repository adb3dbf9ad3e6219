"""A third of all rows on one key: results stay whole and exact.

The skewed input is derived from the driver's events table (one user id
takes every third event); each operator is compared with a brute-force
pandas computation on the same rows.
"""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import evaluation as E
from quire.operators import sampling as S
from quire.sources import upsert as U
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def skewed(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))


def test_hot_user_latency_percentiles(spark, skewed):
    calls = skewed.select("user_id", F.col("value").alias("seconds"),
                          F.when(F.col("event_type") == "error", "error").alias("error"))
    got = {r.user_id: r for r in E.latency_stats(calls, group_cols=["user_id"]).collect()}
    pdf = calls.toPandas()
    hot = pdf[(pdf.user_id == -1) & pdf.error.isna()].seconds.to_numpy()
    assert len(hot) > len(pdf) / 4
    r = got[-1]
    assert r.median == round(float(np.percentile(hot, 50)), 4)
    assert r.p99 == round(float(np.percentile(hot, 99)), 4)
    assert r.n_ok == len(hot)


def test_hot_user_upsert_last_wins(spark, skewed):
    cols = ["user_id", "event_id", "ts", "event_type", "value"]
    out = {r.user_id: r.event_id for r in U.merge(skewed.limit(0).select(*cols), skewed.select(*cols),
                                                   "user_id", ["ts", "event_id"]).collect()}
    pdf = skewed.select(*cols).toPandas().sort_values(["ts", "event_id"])
    want = pdf.groupby("user_id").tail(1).set_index("user_id").event_id.to_dict()
    assert out == want


def test_hot_group_split_is_exact(spark, skewed):
    sp = S.train_test_split(skewed.select("event_id", "user_id"), "user_id", "event_id", "s")
    n_hot = skewed.filter(F.col("user_id") == -1).count()
    hot_train = sp.filter((F.col("user_id") == -1) & (F.col("set") == "train")).count()
    assert hot_train == int(n_hot * 0.7)
    assert sp.count() == skewed.count()


def test_a_key_of_150000_rows_comes_in_parts(spark):
    import json

    from quire.operators import conversations as M

    n = 150_000
    conv = spark.range(0, n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                    F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    conv = conv.unionByName(spark.createDataFrame([(2, 0, "user", None), (2, 1, "user", "x")], "conv_id int, turn long, role string, text string"))

    def whole(parts, col):
        rows = parts.filter("conv_id = 1").orderBy("part_no").collect()
        assert [r.part_no for r in rows] == list(range(len(rows))) and len(rows) > n // M.PART_ROWS
        return "".join(r[col] for r in rows)

    assert whole(M.join_pages(conv, "conv_id", "turn", "text"), "text") == "\n".join(map(str, range(n)))
    assert whole(M.assemble_deltas(conv, "conv_id", "turn", "text"), "reply") == "".join(map(str, range(n)))
    body = json.loads(whole(M.body_parts(M.messages_long(conv, "S"), "conv_id"), "body"))
    assert [m["content"] for m in body["messages"]] == [*map(str, range(n - 1)), "S", str(n - 1)]
    assert body["max_tokens"] == 4000
    assert [(r.part_no, r.text) for r in M.join_pages(conv, "conv_id", "turn", "text").filter("conv_id = 2").collect()] == [(0, "x")]


def test_empty_inputs(spark, tmp_dir):
    calls = spark.createDataFrame([], "seconds double, error string")
    r = E.latency_stats(calls).collect()
    assert len(r) == 1 and r[0].n_ok == 0 and r[0].median is None
    empty = spark.createDataFrame([], "id string, seq long, v string")
    assert U.upsert_table(spark, f"{tmp_dir}/c", empty, "id", ["seq"]) == 0
    assert U.read_current(spark, f"{tmp_dir}/c").count() == 0
    assert S.train_test_split(spark.createDataFrame([], "k long, g string"), "g", "k").count() == 0

"""Pluggable model path (fake model), messages, pages, tokens, streaming restart."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.operators import classify as C
from quire.operators import conversations as M
from quire.operators import tokens as TK


def test_batch_classify_keeps_errors_and_latency(spark):
    df = spark.createDataFrame([(1, "ok text"), (2, "boom"), (3, "")], "id long, text string")

    def model(row: pd.DataFrame):
        t = row["text"].iloc[0]
        if t == "boom":
            raise RuntimeError("model failed")
        return None if t == "" else "label-" + t.split()[0]

    out = {r.id: r for r in C.batch_classify(df, model, "id", ["text"], concurrency=2).collect()}
    assert out[1].prediction == "label-ok" and out[1].error is None and out[1].seconds >= 0
    assert out[2].prediction is None and "model failed" in out[2].error and out[2].seconds is None
    assert out[3].error == "no prediction"


def test_keyword_predict_ties_and_unknown(spark):
    rules = {"x": ("foo",), "y": ("bar",)}
    df = spark.createDataFrame([(1, "foo bar"), (2, "bar bar foo"), (3, "nothing"), (4, None)],
                               "doc_id long, text string")
    got = {r.doc_id: r.prediction for r in C.keyword_classify(df, rules=rules).collect()}
    assert got == {1: "x", 2: "y", 3: "unknown", 4: None}


def test_messages_sync_keeps_existing_system(spark):
    conv = spark.createDataFrame([(1, 0, "system", "SYS"), (1, 1, "user", "hi"), (2, 0, "user", "hey")],
                                 "conv_id long, turn long, role string, text string")
    req = M.split_last_turn(conv)
    sync = {r.conv_id: [(m.role, m.content) for m in r.messages]
            for r in M.messages_sync(req, "SYS").collect()}
    assert sync[1] == [("system", "SYS"), ("user", "hi")]
    assert sync[2] == [("system", "SYS"), ("user", "hey")]
    asy = {r.conv_id: [m.role for m in r.messages] for r in M.messages_async(req, "SYS").collect()}
    assert asy[1] == ["system", "system", "user"]


def test_page_ranges():
    assert M.parse_page_ranges("1-3,5, 7-9") == [(1, 3), (5, 5), (7, 9)]
    with pytest.raises(ValueError):
        M.parse_page_ranges("3-1")


def test_token_estimate_framing(spark):
    conv = spark.createDataFrame([(1, "user", "hello world"), (1, "assistant", "hi")],
                                 "conv_id long, role string, text string")
    r = TK.estimate_conversations(conv).collect()[0]
    # 2 messages x (3 + 1 role token) + 2 + 1 content tokens + 3 priming
    assert r.estimated_tokens == 2 * 4 + 3 + 3
    legacy = TK.estimate_conversations(conv, model="gpt-3.5-turbo-0301").collect()[0]
    assert legacy.estimated_tokens == r.estimated_tokens + 2


def test_stream_ingest_restart_processes_nothing(spark, tmp_dir):
    from quire.streaming import incremental as S

    src, sink, ck = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ck"
    df = spark.range(0, 100).select(F.col("id"), (F.col("id") % 4).alias("day"))
    S.land_files(df, src, "day")
    schema = spark.read.parquet(src).schema
    assert S.ingest_available(spark, src, schema, sink, ck) == 100
    assert S.ingest_available(spark, src, schema, sink, ck) == 0
    S.land_files(spark.range(100, 110).select(F.col("id"), F.lit(9).alias("day")), src, "day")
    assert S.ingest_available(spark, src, schema, sink, ck) == 10
    assert spark.read.parquet(sink).count() == 110


def test_image_classify_with_fake_multimodal_model(spark):
    from quire.functions.text import data_uri

    df = spark.createDataFrame([(1, bytearray(b"\x89PNG-invoice")), (2, bytearray(b"\x89PNG-memo"))],
                               "id long, content binary")
    req = df.select("id", data_uri(F.col("content")).alias("uri"))

    def model(row):
        import base64

        body = base64.b64decode(row["uri"].iloc[0].split(",", 1)[1])
        return "invoice" if b"invoice" in body else "memo"

    out = {r.id: r.prediction for r in C.batch_classify(req, model, "id", ["uri"]).collect()}
    assert out == {1: "invoice", 2: "memo"}
    assert req.first().uri.startswith("data:image/jpeg;base64,")


def test_embed_with_retries_then_succeeds(spark):
    from quire.operators.retrieval import embed_with

    calls = {"n": 0}

    def flaky(texts):
        calls["n"] += 1
        if calls["n"] == 1:
            raise TimeoutError("busy")
        return [[float(len(t)), 1.0] for t in texts]

    df = spark.createDataFrame([(1, "abc"), (2, None)], "id long, text string").coalesce(1)
    got = {r.id: r.embedding for r in embed_with(df, "text", flaky, 2, "id").collect()}
    assert got == {1: [3.0, 1.0], 2: [0.0, 1.0]}


def test_cache_computes_each_missing_key_once(spark):
    from quire.operators import pairing as J

    req = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c")], "rid long, prompt string")
    cache = req.filter("prompt = 'c'").select(J.cache_key(["prompt"]).alias("key"),
                                              F.lit("cached").alias("response"))
    seen = []

    def compute(keys):
        seen.append(keys)
        return keys.select("key", F.concat(F.lit("new:"), "prompt").alias("response"))

    answers, fresh = J.cached_apply(req, cache, ["prompt"], compute)
    got = {r.rid: r.response for r in answers.collect()}
    assert got == {1: "new:a", 2: "new:a", 3: "new:b", 4: "cached"}
    assert fresh.count() == 2


def test_batch_classify_retries(spark):
    df = spark.createDataFrame([(1, "x")], "id long, text string").coalesce(1)
    seen = {"n": 0}

    def flaky(row):
        seen["n"] += 1
        if seen["n"] < 3:
            raise ConnectionError("try later")
        return "ok"

    r = C.batch_classify(df, flaky, "id", ["text"], max_attempts=3, backoff_seconds=0.01).collect()[0]
    assert (r.prediction, r.error) == ("ok", None)
    r2 = C.batch_classify(df, lambda row: 1 / 0, "id", ["text"], max_attempts=2, backoff_seconds=0.01).collect()[0]
    assert r2.prediction is None and "ZeroDivisionError" in r2.error


def test_layout_stream_only_new_files(spark, tmp_dir):
    import os
    import shutil

    from quire.operators.layout import LAYOUT_SCHEMA
    from quire.streaming import incremental as S

    fix = os.path.join(os.path.dirname(__file__), "fixtures", "layout")
    src = f"{tmp_dir}/incoming"
    os.makedirs(f"{src}/memo")
    shutil.copy(f"{fix}/memo/memo_1.png.ocr.json", f"{src}/memo/")
    args = (spark, src, f"{tmp_dir}/sink", f"{tmp_dir}/ck", LAYOUT_SCHEMA)
    assert S.ingest_layouts(*args) == 1
    assert S.ingest_layouts(*args) == 0
    os.makedirs(f"{src}/invoice")
    shutil.copy(f"{fix}/invoice/invoice_2.png.ocr.json", f"{src}/invoice/")
    assert S.ingest_layouts(*args) == 1
    files = sorted(os.path.basename(r.file) for r in spark.read.parquet(f"{tmp_dir}/sink").collect())
    assert files == ["invoice_2.png.ocr.json", "memo_1.png.ocr.json"]


@pytest.mark.parametrize("mode", ["async", "sync"])
def test_long_form_messages_equal_array_form(spark, mode):
    conv = spark.createDataFrame(
        [(1, 0, "system", "SYS"), (1, 1, "user", "hi"), (1, 2, "assistant", "yo"), (1, 3, "user", "q"),
         (2, 5, "user", "only"), (3, 0, "user", "a"), (3, 7, "user", "b")],
        "conv_id long, turn long, role string, text string")
    req = M.split_last_turn(conv)
    arr = M.messages_async(req, "SYS") if mode == "async" else M.messages_sync(req, "SYS")
    want = arr.select("conv_id", F.posexplode("messages").alias("pos", "m")).select(
        "conv_id", "pos", "m.role", F.col("m.content").alias("content"))
    got = M.messages_long(conv, "SYS", mode, bucket_width=2)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_conversation_validity_rows_equal_array_check(spark):
    conv = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 1, None, "b"),            # null role on the last turn: becomes 'user'
         (2, 0, None, "c"), (2, 1, "user", "d"),            # null role in the history
         (3, 0, "user", "e"), (3, 1, "user", None),         # empty prompt
         (4, 0, "user", "f")],
        "conv_id long, turn long, role string, text string")
    rows = {r.conv_id: r.valid for r in M.conversations_valid(conv).collect()}
    arr = {r.conv_id: r.v for r in M.messages_async(M.split_last_turn(conv), "S")
           .select("conv_id", M.messages_valid(F.col("messages")).alias("v")).collect()}
    assert rows == arr == {1: True, 2: False, 3: False, 4: True}

"""Outcomes per row, jobs that are run again, pacing, the stored cache, reranking by a model."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.operators import calls as CL
from quire.operators import response_cache as RC
from quire.operators import retrieval as R
from quire.session import fresh_folder


def noted(folder, name):
    """Count calls across processes: a file per call."""
    import uuid

    open(os.path.join(folder, f"{name}-{uuid.uuid4().hex}"), "w").close()


def count_of(folder, name):
    return sum(f.startswith(f"{name}-") for f in os.listdir(folder))


# ---- outcomes ---------------------------------------------------------------------

def test_bad_rows_are_isolated_by_halving(spark, tmp_dir):
    df = spark.createDataFrame([(i, "bad" if i in (3, 40, 41) else f"t{i}") for i in range(64)], "id long, t string").coalesce(1)

    def call(frame):
        noted(tmp_dir, "call")
        if (frame["t"] == "bad").any():
            raise ValueError("cannot read")
        return {"n": [len(t) for t in frame["t"]]}

    out = {r["id"]: r for r in CL.call_outcomes(df, ["id"], ["t"], call, "n int").collect()}
    assert len(out) == 64
    assert {i for i, r in out.items() if r["error"]} == {3, 40, 41}
    assert out[3]["error"] == "ValueError: cannot read" and out[3]["n"] is None and out[5]["n"] == 2
    assert count_of(tmp_dir, "call") <= 1 + 3 * 2 * 6


def test_a_busy_service_is_asked_again_with_the_whole_frame():
    seen, waits = [], []

    def call(frame):
        seen.append(len(frame))
        if len(seen) < 3:
            raise CL.Transient("busy")
        return {"x": list(frame["t"])}

    got = CL.settle(pd.DataFrame({"t": [1, 2, 3]}), call, 6, sleep=waits.append)
    assert seen == [3, 3, 3] and [r[0]["x"] for r in got] == [1, 2, 3] and [r[2] for r in got] == [3, 3, 3]
    assert len(waits) == 2 and all(0 < w <= CL.LONGEST_WAIT for w in waits)


def test_single_rows_are_retried_and_then_given_up():
    calls = []

    def call(frame):
        calls.append(len(frame))
        raise KeyError("x")

    got = CL.settle(pd.DataFrame({"t": [1, 2]}), call, 3, sleep=lambda s: None)
    assert calls == [2, 1, 1, 1, 1, 1, 1] and [r[1] for r in got] == ["KeyError: 'x'"] * 2 and [r[2] for r in got] == [4, 4]


def test_too_few_results_are_an_error():
    got = CL.settle(pd.DataFrame({"t": [1, 2]}), lambda f: {"x": [1]}, 1)
    assert [r[1] for r in got] == [None, None]  # halved: one result for one row each
    got = CL.settle(pd.DataFrame({"t": [1]}), lambda f: {"x": []}, 1)
    assert got[0][1] == "ValueError: 0 results for 1 rows"


def test_frames_are_bounded_in_rows_and_bytes():
    pdf = pd.DataFrame({"t": ["x" * n for n in (5, 5, 50, 1, 1, 1)]})
    assert [len(f) for f in CL._frames(pdf, ["t"], 2, 20)] == [2, 1, 2, 1]
    assert [len(f) for f in CL._frames(pdf.iloc[:0], ["t"], 2, 20)] == []


def test_pacer_keeps_the_rate_and_pauses():
    now, waits = [0.0], []

    def sleep(s):
        waits.append(round(s, 3))
        now[0] += s

    p = CL.Pacer(60, concurrency=4, window=30, clock=lambda: now[0], sleep=sleep)
    for _ in range(3):
        p.before()
    assert waits == [4.0, 4.0]
    p.after("100")
    p.after(None)
    p.after("soon")
    p.before()
    p.after("2")  # fewer than there are tasks
    p.before()
    assert waits == [4.0, 4.0, 4.0, 30.0]


# ---- embeddings ---------------------------------------------------------------------

def test_embedding_outcomes(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None), (3, "long"), (4, "abc")], "id long, t string").coalesce(1)

    def model(texts):
        if "long" in texts:
            raise RuntimeError("refused")
        return [[float(len(t))] * (2 if t != "abc" else 3) for t in texts]

    out = {r["id"]: (r["embedding"], r["error"]) for r in CL.embed_outcomes(df, "t", model, 2, "id", max_attempts=1).collect()}
    assert out == {1: ([2.0, 2.0], None), 2: ([0.0, 0.0], None), 3: (None, "RuntimeError: refused"), 4: (None, "ValueError: expected 2 numbers, got 3")}


# ---- jobs -------------------------------------------------------------------------------

def requests(spark, n=60):
    return spark.createDataFrame([(i, f"t{i}") for i in range(n)], "id long, t string")


def test_a_job_run_again_calls_only_what_has_no_result(spark, tmp_dir):
    path = fresh_folder(spark, "job")

    def call(frame):
        for i, r in zip(frame["id"], frame["round"]):
            noted(tmp_dir, f"row{i}")
        if ((frame["id"] % 10 == 0) & (frame["round"] == 1)).any():
            raise RuntimeError("down")
        return {"up": [t.upper() for t in frame["t"]]}

    def job(rounds, n=60):
        out = CL.run_job(path, requests(spark, n), "id", ["id", "t"], call, "up string", concurrency=2, rows_per_commit=7, max_rounds=rounds, rows=1)
        return {r["id"]: r for r in out.collect()}

    one = job(1)
    assert {i for i, r in one.items() if r["error"]} == {0, 10, 20, 30, 40, 50}
    two = job(2)
    assert all(r["error"] is None and r["up"] == f"T{i}" for i, r in two.items()) and len(two) == 60
    assert {i: r["round"] for i, r in two.items()} == {i: 2 if i % 10 == 0 else 1 for i in range(60)}
    assert all(count_of(tmp_dir, f"row{i}") == (2 if i % 10 == 0 else 1) for i in range(60))
    more = job(2, 65)  # new requests join, finished ones are left alone
    assert len(more) == 65 and count_of(tmp_dir, "row61") == 1 and count_of(tmp_dir, "row5") == 1


def test_what_finished_tasks_stored_survives_a_failed_job(spark, tmp_dir):
    path, crash = fresh_folder(spark, "job"), os.path.join(tmp_dir, "crash-on")
    open(crash, "w").close()

    def call(frame):
        for i in frame["id"]:
            noted(tmp_dir, f"row{i}")
        if (frame["id"] == 59).any() and os.path.exists(crash):
            import time

            time.sleep(3)  # the other tasks of the wave end first
            os._exit(1)  # the worker dies: no outcome, the job fails
        return {"up": [t.upper() for t in frame["t"]]}

    args = dict(concurrency=3, rows_per_commit=20, max_rounds=1, rows=1)
    with pytest.raises(Exception):
        CL.run_job(path, requests(spark), "id", ["id", "t"], call, "up string", **args)
    done = {r["id"] for r in CL.job_results(spark, path, "id").collect()}
    assert done and 59 not in done
    os.remove(crash)
    out = CL.run_job(path, requests(spark), "id", ["id", "t"], call, "up string", **args).collect()
    assert sorted(r["id"] for r in out) == list(range(60))
    assert all(count_of(tmp_dir, f"row{i}") == 1 for i in done)


def test_empty_and_always_failing_jobs(spark):
    def call(frame):
        raise RuntimeError("never")

    path = fresh_folder(spark, "job")
    assert CL.run_job(path, requests(spark, 0), "id", ["id"], call, "x int").count() == 0
    out = CL.run_job(path, requests(spark, 3), "id", ["id"], call, "x int", max_rounds=2).collect()
    assert [(r["id"], r["x"], r["error"], r["round"]) for r in sorted(out)] == [(i, None, "RuntimeError: never", 2) for i in range(3)]


# ---- cache --------------------------------------------------------------------------------

def test_cache_computes_a_key_once_and_stores_it(spark, tmp_dir):
    path = fresh_folder(spark, "cache")

    def compute(missing):
        def run(batches):
            for pdf in batches:
                for t in pdf["t"]:
                    noted(tmp_dir, f"made-{t}")
                yield pd.DataFrame({"key": pdf["key"], "response": [None if t == "fails" else f"r:{t}" for t in pdf["t"]]})
        return missing.mapInPandas(run, "key string, response string")

    def ask(texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
        a = RC.answer(path, df, ["t"], compute)
        return a.computed, {r["id"]: (r["response"], r["hit"]) for r in a.rows.collect()}

    n, rows = ask(["a", "b", "a", "fails", None, "a"])
    assert n == 3 and rows[0] == rows[2] == rows[5] == ("r:a", False) and rows[3] == (None, False) and rows[4] == ("r:None", False)
    n, rows = ask(["a", "c", "fails"])
    assert n == 1 and rows == {0: ("r:a", True), 1: ("r:c", False), 2: (None, False)}
    assert count_of(tmp_dir, "made-a") == 1 and count_of(tmp_dir, "made-fails") == 2
    assert ask([]) == (0, {})


def test_cache_reads_only_the_folders_asked_for(spark):
    path = fresh_folder(spark, "cache")
    RC.answer(path, spark.range(200).select(F.col("id").cast("string").alias("t")), ["t"], lambda m: m.select("key", F.col("t").alias("response")))
    plan = RC.entries(spark, path, ["07", "1e"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "prefix" in plan.split("PartitionFilters")[1][:60]
    assert RC.entries(spark, path).count() == 200
    got = {r["key"][:2] for r in RC.entries(spark, path, ["07", "1e"]).collect()}
    assert got <= {"07", "1e"}


def test_one_stream_answers_the_requests_of_many_clients(spark, tmp_dir):
    path, src, sink, ckpt = (f"{tmp_dir}/{x}" for x in ("cache", "in", "out", "ckpt"))

    def compute(missing):
        def run(batches):
            for pdf in batches:
                for t in pdf["t"]:
                    noted(tmp_dir, f"made-{t}")
                yield pd.DataFrame({"key": pdf["key"], "response": pdf["t"]})
        return missing.mapInPandas(run, "key string, response string")

    for client in range(3):
        spark.createDataFrame([(client, "same"), (client, f"own{client}")], "c long, t string").coalesce(1).write.mode("append").json(src)
    schema = spark.read.json(src).select("c", "t").schema
    for _ in range(2):
        RC.serve(spark, src, schema, path, sink, ckpt, ["t"], compute, max_files_per_trigger=1)
    out = spark.read.parquet(sink).collect()
    assert sorted((r["c"], r["response"]) for r in out) == sorted((c, t) for c in range(3) for t in ("same", f"own{c}"))
    assert count_of(tmp_dir, "made-same") == 1


# ---- reranking ------------------------------------------------------------------------------

def test_rerank_with_a_model(spark):
    cand = spark.createDataFrame([(1, 10, 0.5), (1, 11, 0.9), (1, 12, 0.1), (1, 13, 0.2), (2, 10, 0.3)], "qid long, doc_id long, score double")
    docs = spark.createDataFrame([(10, "aa"), (11, "b"), (12, "bad"), (13, "aa"), (99, "unused")], "d long, t string")
    queries = spark.createDataFrame([(1, "a"), (2, None)], "q long, x string")

    def model(pairs):
        assert all(t != "unused" for _, t in pairs)
        if any(t == "bad" for _, t in pairs):
            raise ValueError("refused")
        return [t.count(q) if q else 0 for q, t in pairs]

    out = R.rerank_with(cand, docs, "d", "t", queries, "q", "x", model, top=4).collect()
    got = sorted((r["qid"], r["rank"], r["doc_id"], r["rerank_score"], r["error"]) for r in out)
    assert got == [(1, 1, 10, 2.0, None), (1, 2, 13, 2.0, None), (1, 3, 11, 0.0, None), (1, 4, 12, None, "ValueError: refused"), (2, 1, 10, 0.0, None)]


def test_vectors_reach_the_outcome_without_a_frame(monkeypatch):
    import numpy as np
    import pandas as pd

    from quire.operators import calls as CL

    part = pd.DataFrame({"t": ["a", "b"]})
    monkeypatch.setattr(CL.pd, "DataFrame", None)  # a frame of vectors is not made
    found = CL.settle(part, lambda f: {"embedding": [np.ones(3, np.float32), np.zeros(3, np.float32)]}, 1)
    assert [r[0]["embedding"].tolist() for r in found] == [[1, 1, 1], [0, 0, 0]] and [r[1] for r in found] == [None, None]

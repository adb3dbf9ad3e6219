"""Vectors of few numbers: searched by their postings, embedded and measured in bounded memory."""

import numpy as np
from pyspark.sql import functions as F

from quire.operators import invoices as I
from quire.operators import retrieval as R
from quire.plans import invoices as P
from tests.conftest import SF_SMALL


def sparse(seed, n, dim, used=6, signed=False):
    rng = np.random.default_rng(seed)
    m = np.zeros((n, dim))
    for row in m:
        at = (rng.zipf(1.3, used) - 1) % dim  # some places are in most rows, some in few
        row[at] = rng.integers(1, 4, used) * (rng.choice([-1, 1], used) if signed else 1)
    m[n // 2] = 0
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def test_postings_give_what_all_products_give():
    for signed in (False, True):
        m = sparse(3, 6000, 400, signed=signed)
        q, ids = m[::60], np.arange(6000)[::-1]
        every, own = R.RunningTop(len(q), 4), R.RunningTop(len(q), 4)
        rows = R.SparseRows(q, own)
        for lo in range(0, 6000, 500):
            every.add(ids[lo:lo + 500], R.cosine_scores(m[lo:lo + 500], q))
            rows.add(ids[lo:lo + 500], m[lo:lo + 500])
        rows.search()
        assert np.array_equal(own.ids, every.ids) and np.array_equal(own.query, every.query) and np.allclose(own.score, every.score, atol=1e-12)


def test_few_rows_reach_the_scores(monkeypatch):
    m = sparse(5, 20000, 400)
    scored, plain = [], np.einsum
    monkeypatch.setattr(np, "einsum", lambda how, a, b: scored.append(len(a)) or plain(how, a, b))
    rows = R.SparseRows(m[:50], R.RunningTop(50, 3))
    rows.add(np.arange(10000), m[:10000])
    rows.add(np.arange(10000, 20000), m[10000:])
    assert sum(scored[50:]) < 0.5 * 50 * 10000  # the second ten thousand


def test_a_search_over_sparse_and_dense_rows(spark):
    m = sparse(7, 300, 64, used=1)
    data = [(i, [float(x) for x in (v if i % 2 else np.random.default_rng(i).standard_normal(64))]) for i, v in enumerate(m)] + [(900, None), (7, [0.0] * 64)]
    v = spark.createDataFrame(data, "id long, v array<double>")
    q = v.filter("id % 30 = 1").select(F.col("id").alias("q"), F.col("v").alias("w"))
    a = np.array([x for _, x in data if x is not None])
    ids, unit = np.array([i for i, x in data if x is not None]), a / np.where(np.linalg.norm(a, axis=1, keepdims=True) == 0, 1, np.linalg.norm(a, axis=1, keepdims=True))
    for r in R.vector_search(v, "id", "v", q, "q", "w", k=2).collect():
        s = np.round(unit @ unit[np.flatnonzero(ids == r["qid"])[0]], R.SCORE_DIGITS)
        best = np.lexsort((ids, -s))[r["rank"] - 1]
        assert (r["vid"], r["score"]) == (ids[best], s[best])


def test_stats_of_vectors_and_embeddings(spark):
    v = spark.createDataFrame([(1, [0.0, 0.5, -2.0]), (2, None), (3, []), (4, [1e-60, 3.0])], "id long, v array<double>")
    got = {r["id"]: tuple(r["s"]) if r["s"] else (None,) * 3 for r in v.select("id", R.vector_stats("v").alias("s")).collect()}
    assert got == {1: (3, 1, 4.25), 2: (None,) * 3, 3: (0, 0, 0.0), 4: (2, 1, 9.0)}
    t = spark.createDataFrame([("a b a",), (None,), ("",)], "t string").select(R.vector_stats(R.hashed_embedding("t", 1536)).alias("s"))
    assert sorted((r["s"]["dim"], r["s"]["n_used"], round(r["s"]["norm2"], 6)) for r in t.collect()) == [(1536, 0, 0.0), (1536, 0, 0.0), (1536, 2, 1.0)]
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # both in one worker


def test_vectors_are_dealt_out_by_rows(spark):
    assert P._invoice_vectors(spark, SF_SMALL).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_a_check_that_keeps_columns_computes_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(1, [("a", 1.1, 2)], 2.2), (2, [("b", 1.0, 1)], 5.0), (3, None, 0.0), (4, [("c", 1.0, 1)], None)]
    kind = "id long, items array<struct<name string, price double, quantity int>>, total double"
    inv = spark.createDataFrame(rows, kind).mapInArrow(count, kind)
    good, bad = I.total_check(inv, keep=["id", "total"])
    assert {r["id"] for r in good.collect()} == {1, 3} and {(r["id"], r["reason"]) for r in bad.collect()} == {(2, "total mismatch"), (4, "total mismatch")}
    assert seen.value == 4 and good.columns == ["id", "total", "calculated_total", "total_matches"]


def test_few_vectors_are_scored_at_once(spark):
    vectors = spark.range(0, 5000, 1, 1).select(F.col("id").alias("vid"), F.array(F.lit(1.0), F.col("id").cast("double")).alias("v"))
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "qid long, qv array<double>")
    # every vector's score is the number of vectors scored with it
    got = R._search(vectors, "vid", "v", queries, "qid", "qv", 5000, lambda v, q: np.full((len(v), len(q)), float(len(v)))).collect()
    assert len(got) == 5000 and max(r["score"] for r in got) <= R.SCORE_BLOCK_ROWS


def test_a_large_query_set_is_searched_by_stored_numbers(spark, monkeypatch):
    m = sparse(11, 900, 64, used=2)
    data = [(f"v{i:03d}", [float(x) for x in (v if i % 5 else np.random.default_rng(i).standard_normal(64))]) for i, v in enumerate(m)]
    data += [("none", None), ("v007", data[7][1]), ("zero", [0.0] * 64), ("twin", data[30][1])]
    v = spark.createDataFrame(data, "id string, v array<double>").repartition(5)
    q = v.filter("id rlike '[05]$' or id = 'zero'").select(F.col("id").alias("q"), F.col("v").alias("w"))
    want = sorted(map(tuple, R.vector_search(v, "id", "v", q, "q", "w", k=3).collect()))
    monkeypatch.setattr(R, "SMALL_QUERY_SET", 10)
    for most, rows in ((64 << 20, 1 << 18), (20_000, 100)):
        monkeypatch.setattr(R, "QUERY_BLOCK_BYTES", most)
        monkeypatch.setattr(R, "COMPACT_ROWS", rows)
        monkeypatch.setattr(R, "best_per_task", None)  # whole vectors are not sent again
        assert sorted(map(tuple, R.vector_search(v, "id", "v", q, "q", "w", k=3).collect())) == want


def test_a_known_bound_leaves_most_rows_out(monkeypatch):
    m = sparse(5, 20000, 400)
    q = R.CompactRows(*(lambda n, at, x: (np.r_[0, np.cumsum(n)], at, x))((m[:50] != 0).sum(axis=1), np.nonzero(m[:50])[1], m[:50][m[:50] != 0]), 400)
    plain = R.SparseRows(m[:50], R.RunningTop(50, 3))
    plain.add(np.arange(20000), m)
    plain.search()
    scored, einsum = [], np.einsum
    monkeypatch.setattr(np, "einsum", lambda how, a, b: scored.append(len(a)) or einsum(how, a, b))
    own = R.SparseRows(q, R.RunningTop(50, 3, plain.top.least.copy()), 1 << 18, 1 << 18)
    own.add(np.arange(20000), m)
    own.search()
    assert np.array_equal(own.top.ids, plain.top.ids) and np.array_equal(own.top.score, plain.top.score)
    assert sum(scored) < 0.5 * 50 * 20000

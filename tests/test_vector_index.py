"""The inverted-file vector index against the exhaustive search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import retrieval as R
from quire.operators import vector_index as VI
from tests.conftest import SF_SMALL

SCHEMA = "id long, v array<double>"


def table(spark, m, ids=None):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids if ids is not None else range(len(m)), m)], SCHEMA)


def clustered(seed, n, dim=16, groups=30, noise=0.15):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dim))
    return centres[rng.integers(0, groups, n)] + noise * rng.standard_normal((n, dim))


def rows(df):
    return sorted((r["qid"], r["rank"], r["vid"], r["score"]) for r in df.collect())


def test_exact_search_equals_brute_force(spark):
    v = table(spark, clustered(1, 3000))
    q = v.filter("id % 100 = 0").select(F.col("id").alias("q"), F.col("v").alias("w"))
    index = VI.build_index(v, "id", "v")
    assert sum(r["n"] for r in index.cells.collect()) == 3000
    got, report = VI.search(index, q, "q", "w", k=5)
    assert rows(got) == rows(R.vector_search(v, "id", "v", q, "q", "w", k=5))
    assert report.share < 0.5 and report.rounds >= 1


def test_ties_zero_null_and_repeated_vectors(spark):
    same = [1.0, 0.0, 0.0]
    data = [(i, same) for i in range(40)] + [(i, [0.0, 0.0, 0.0]) for i in range(40, 45)] + [(50, None), (60, [0.0, 1.0, 0.0]), (61, [0.0, -1.0, 1e-9]), (0, same)]
    v = spark.createDataFrame(data, SCHEMA)
    q = spark.createDataFrame([(1, same), (2, [0.0, 0.0, 0.0]), (3, [0.0, 2.0, 0.0]), (4, None)], "q long, w array<double>")
    index = VI.build_index(v, "id", "v")
    got, _ = VI.search(index, q, "q", "w", k=4)
    assert rows(got) == rows(R.vector_search(v, "id", "v", q, "q", "w", k=4))


@pytest.mark.parametrize("data", [[], [(1, None)], [(7, [1.0, 2.0])]])
def test_tiny_collections(spark, data):
    v = spark.createDataFrame(data, SCHEMA)
    q = spark.createDataFrame([(1, [1.0, 1.0])], "q long, w array<double>")
    index = VI.build_index(v, "id", "v")
    got, report = VI.search(index, q, "q", "w", k=3)
    assert [r[:3] for r in rows(got)] == [(1, 1, 7)] * bool(data and data[0][1])
    assert VI.search(index, q.limit(0), "q", "w")[0].count() == 0


def test_string_ids_and_reopening(spark):
    m = clustered(5, 400, 8)
    v = table(spark, m).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("id"), "v")
    q = v.limit(5).select(F.col("id").alias("q"), F.col("v").alias("w"))
    index = VI.VectorIndex.open(spark, VI.build_index(v, "id", "v", cells=12).path)
    assert rows(VI.search(index, q, "q", "w")[0]) == rows(R.vector_search(v, "id", "v", q, "q", "w"))


def test_only_the_asked_cells_are_read(spark):
    index = VI.build_index(table(spark, clustered(2, 500)), "id", "v", cells=10)
    plan = index.vectors([1, 2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan
    assert {r["cell"] for r in index.vectors([1, 2]).select("cell").distinct().collect()} <= {1, 2}


def test_expected_recall_holds_on_unstructured_vectors(spark):
    rng = np.random.default_rng(3)
    v = table(spark, rng.standard_normal((8000, 24)))
    q = v.filter("id % 100 = 0").select(F.col("id").alias("q"), F.col("v").alias("w"))
    index = VI.build_index(v, "id", "v")
    want = {r[:1] + r[2:3] for r in rows(R.vector_search(v, "id", "v", q, "q", "w", k=10))}
    for recall in (0.9, 0.98):
        got, report = VI.search(index, q, "q", "w", k=10, recall=recall)
        found = {r[:1] + r[2:3] for r in rows(got)}
        assert len(found) == len(want) and len(found & want) / len(want) >= recall - 0.03
        assert report.share < 0.95


def test_normal_tail():
    from math import erfc, sqrt

    z = np.linspace(-6, 6, 49)
    assert np.allclose(VI.normal_above(z), [0.5 * erfc(x / sqrt(2)) for x in z], atol=2e-7)


def test_recall_on_the_given_vectors(spark):
    v = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    q = v.filter("id % 10 = 0").select(F.col("id").alias("q"), F.col("v").alias("w"))
    index = VI.build_index(v, "id", "v")
    exact = rows(R.vector_search(v, "id", "v", q, "q", "w", k=3))
    assert rows(VI.search(index, q, "q", "w", k=3)[0]) == exact
    got = rows(VI.search(index, q, "q", "w", k=3, recall=0.95)[0])
    assert len(set(r[::2] for r in got) & set(r[::2] for r in exact)) / len(exact) >= 0.9

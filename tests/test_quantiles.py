"""Two-pass exact percentiles equal numpy's linear interpolation, even with hot values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import quantiles as Q
from quire.operators.quantiles import exact_quantiles

PS = [0.5, 0.95, 0.99, 0.0, 1.0, 0.37]


def test_global_matches_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.gamma(2.0, 3.0, 20000), 2).tolist() + [7.5] * 9000  # a hot repeated value
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "x double")
    r = exact_quantiles(df, "x", PS).collect()[0]
    for p, name in zip(PS, ["p50", "p95", "p99", "p0", "p100", "p37"]):
        assert r[name] == pytest.approx(float(np.percentile(vals, p * 100)), abs=1e-9)


def test_grouped_matches_numpy(spark):
    rng = np.random.default_rng(5)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 4, 6000), rng.normal(10, 3, 6000))]
    rows += [(9, 1.0)]  # a one-row group
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r.g: r for r in exact_quantiles(df, "x", [0.5, 0.99], ["g"], ["med", "p99"]).collect()}
    for g in {r[0] for r in rows}:
        xs = [x for gg, x in rows if gg == g]
        assert got[g].med == pytest.approx(float(np.percentile(xs, 50)), abs=1e-9)
        assert got[g].p99 == pytest.approx(float(np.percentile(xs, 99)), abs=1e-9)


def test_large_group_uses_sketch_band(spark):
    # n far above accuracy: the band path (not the whole-group path) is exercised
    rng = np.random.default_rng(11)
    vals = np.round(rng.exponential(5.0, 50000), 3).tolist()
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    r = exact_quantiles(df, "x", [0.5, 0.95, 0.99, 0.01]).collect()[0]
    for p, name in zip([0.5, 0.95, 0.99, 0.01], ["p50", "p95", "p99", "p1"]):
        assert r[name] == pytest.approx(float(np.percentile(vals, p * 100)), abs=1e-9)


def test_summaries_of_parts_merge_into_the_summary_of_all(spark):
    rng = np.random.default_rng(5)
    days = [(d, float(v), None) for d in range(7) for v in rng.lognormal(d / 3, 1, 3000)] + [(8, None, "failed"), (8, None, "failed"), (9, 1.0, None)]
    log = spark.createDataFrame(days, "day int, s double, e string").repartition(6)
    daily = Q.summaries(log, "s", "e", ["day"])
    assert daily.count() == 9
    ps, names = [0.0, 0.5, 0.95, 0.99, 1.0], ["p0", "p50", "p95", "p99", "p100"]
    r = Q.sketch_quantiles(Q.merged(Q.merged(daily, ["day"])), ps, names).first()
    good = np.array([v for _, v, e in days if e is None])
    assert (r.n_ok, r.errors) == (len(good), 2)
    assert abs(r["mean"] - good.mean()) < 1e-9 and (r["min"], r["max"]) == (good.min(), good.max()) == (r.p0, r.p100)
    errors = {x["p"]: x["rank_error"] for x in Q.rank_errors(log.filter("e is null"), "s", dict(zip(ps, r[-5:]))).collect()}
    assert set(errors) == set(ps) and max(errors.values()) <= Q.SKETCH_ERROR
    of = {x["day"]: x for x in Q.sketch_quantiles(daily, [0.5], ["m"]).collect()}
    assert of[8].m is None and of[8].errors == 2 and of[9].m == 1.0


def test_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "day int, s double, e string")
    r = Q.sketch_quantiles(Q.merged(Q.summaries(empty, "s", "e", ["day"])), [0.5], ["m"]).collect()
    assert len(r) == 1 and (r[0].n_ok, r[0].errors, r[0].m) == (0, 0, None)


def test_rank_error_of_a_repeated_value_is_zero(spark):
    v = spark.createDataFrame([(1.0,)] * 90 + [(2.0,)] * 10, "v double")
    got = {r["value"]: round(r["rank_error"], 6) for r in Q.rank_errors(v, "v", {0.5: 1.0, 0.25: 2.0}).collect()}
    assert got == {1.0: 0.0, 2.0: 0.65}

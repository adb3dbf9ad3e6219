import hashlib
import math
import random

import numpy as np
import pytest

from quire.llm import orchard_codes as OC
from quire.llm.common import join_counted
from tests.llm.fixtures import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def kept(rows):
    ok = [r for r in rows if r[1] is not None and r[1] and all(x is not None and math.isfinite(x) and abs(x) < 2 ** 18 for x in r[1]) and len(r[1]) % 4 == 0]
    ok = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], y) for i, v, y in ok]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    return [r for r in ok if len(r[1]) == len(ok[0][1])]


def brute(rows, entries=256, rounds=4):
    ok = kept(rows)
    if not ok:
        return []
    w = len(ok[0][1]) // 4
    parts = [[r[1][p * w:(p + 1) * w] for r in ok] for p in range(4)]
    books = [x[:entries] for x in parts]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            of = [best(x, books[p])[1] for x in parts[p]]
            new = []
            for k, e in enumerate(books[p]):
                own = [x for x, i in zip(parts[p], of) if i == k]
                new.append([sum(c) // len(own) for c in zip(*own)] if own else e)
            books[p] = new
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[best(parts[p][i], books[p]) for p in range(4)] for i in range(len(ok))]
    error = [sum(d for d, _ in f) for f in found]
    label = {}
    for r, e in zip(ok, error):
        label[r[2]] = label.get(r[2], 0) + e
    return [(r[0], "".join(f"{k:02x}" for _, k in f), e, label[r[2]], sha) for r, f, e in zip(ok, found, error)]


def hard_rows(seed, n=400, dim=8):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([rng.uniform(-1, 1), rng.randint(-2, 2) / 4]) for _ in range(dim)], rng.choice([None, 0, 1, 2])) for i in range(n)]
    same = [0.5] * dim
    rows += [(n + i, same, 0) for i in range(150)]  # a large group of copies
    rows += [(None, same, None), (5, rows[5][1], 9), (5, rows[5][1], 9), (n + 200, None, 1), (n + 201, [], 1), (n + 202, [1.0, None] + same[2:], 1),
             (n + 203, [float("nan")] + same[1:], 1), (n + 204, [float("-inf")] + same[1:], 1), (n + 205, same[:4], 1), (n + 206, [3e38] + same[1:], 1), (n + 207, same[:3], 1),
             (n + 208, [262143.0] + same[1:], 1)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,scale", [(0, 3), (1, 40), (2, 100_000)])
def test_orchard_finds_the_nearest_entry(seed, scale):
    rng = np.random.default_rng(seed)
    for size in (1, 2, 7, 256):
        book = OC.codebook(rng.integers(-scale, scale, (size, 5)))
        points = rng.integers(-scale, scale, (300, 5))
        index, dist, evaluated = OC.nearest(points, book)
        d = ((points[:, None] - book.entries[None]) ** 2).sum(axis=2)
        assert (index == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()
        assert evaluated <= 300 * size


def test_the_search_skips_entries():
    rng = np.random.default_rng(4)
    centres = rng.integers(-10_000, 10_000, (256, 4))
    points = centres[rng.integers(0, 256, 2000)] + rng.integers(-30, 30, (2000, 4))
    _, _, evaluated = OC.nearest(points, OC.codebook(centres))
    assert evaluated < 0.6 * 2000 * 256


def test_equals_brute_force(spark):
    rows = hard_rows(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = [tuple(r) for r in OC.code_report(df).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


def test_few_rows_clashing_columns_and_decoding(spark):
    rows = hard_rows(2, 20)[:40]
    df = clashing(spark.createDataFrame(rows, SCHEMA)).toDF("vec_id", "embedding", "label", "code", "v", "a.b", "error", "n", "part")
    got = [tuple(r) for r in OC.code_report(df).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    coded, books = OC.compress(df)
    codes = coded.filter("vec_id < 20").collect()
    ints = {r[0]: r[1] for r in kept(rows)}
    back = OC.decoded(books, np.array([r["code"] for r in codes]))
    for r, v in zip(codes, back):
        if r["vec_id"] != 5:
            assert sum((a - b) ** 2 for a, b in zip(ints[r["vec_id"]], v.tolist())) == r["error"]


@pytest.mark.parametrize("rows", [[], [(1, None, 2)], [(1, [1.0, 2.0, 3.0], 1)]])
def test_no_kept_row(spark, rows):
    got = OC.code_report(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and got.count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_counted_join(spark, how, monkeypatch):
    from pyspark.sql import functions as F

    from quire.llm import common

    monkeypatch.setattr(common, "HOT_KEYS", 2)
    rows = spark.createDataFrame([(i, k, None) for i, k in enumerate(["a"] * 9 + ["b"] * 5 + [None] * 3 + ["c", "d", "d"])], "i int, k string, x string")
    per = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("first")).filter("k is null or k <> 'c'")
    got = join_counted(rows, per, ["k"], "n", how).collect()
    first = {"a": 0, "b": 9, None: 14, "d": 18}
    want = [(i, r["k"], first.get(r["k"])) for i, r in enumerate(rows.collect()) if how == "left" or r["k"] != "c"]
    assert sorted((r["i"], r["k"], r["first"]) for r in got) == sorted(want)

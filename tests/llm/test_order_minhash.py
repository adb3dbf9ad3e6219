import collections
import random

import numpy as np
import pyarrow as pa

from quire.llm import order_minhash
from quire.llm.order_minhash import components, dedupe, keys_of, labelled, near_duplicates, rare_pairs, similarity
from tests.llm.fixtures import EN, clashing, documents, frame, prose
from tests.llm.test_decontaminate import words


def shingles(text):
    w = words(text)
    seen, out = collections.Counter(), []
    for k in range(max(1, len(w) - 4) if w else 0):
        g = tuple(w[k:k + 5])
        out.append((g, seen[g]))
        seen[g] += 1
    return out


def chain(a, b):
    """Longest common subsequence of two sequences, by the plain table."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_labelled_shingles_match_as_the_plain_ones():
    rng = random.Random(1)
    texts = [prose(rng, EN[:6], rng.randint(0, 40)) for _ in range(40)] + [None, "", "a b", "a b c d e", "x x x x x x x x"]
    got = labelled(pa.array(texts, pa.string()))
    back = {}
    for t, h in zip(texts, got, strict=True):
        own = shingles(t)
        assert len(own) == len(h)
        for g, x in zip(own, h.tolist(), strict=True):
            assert back.setdefault(g, x) == x
    assert len(set(back.values())) == len(back)


def test_banded_alignment_is_exact_from_the_threshold_on():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.randrange(10 ** 9) for _ in range(rng.randint(1, 60))]
        b = [x for x in a if rng.random() > 0.08]
        for _ in range(rng.randint(0, 4)):
            b.insert(rng.randint(0, len(b)), rng.randrange(10 ** 9))
        if rng.random() < 0.3 and len(b) > 4:
            b = b[3:] + b[:3]
        if not b:
            continue
        c = chain(a, b)
        want = c / (len(a) + len(b) - c)
        got = similarity(np.array(a, np.uint64), np.array(b, np.uint64))
        assert got <= want + 1e-12 and (want < 0.8 or abs(got - want) < 1e-12)


def test_keys_follow_order():
    x = labelled(pa.array([" ".join(f"w{k}" for k in range(200))]))[0]
    assert (keys_of(x) == keys_of(x.copy())).all()
    assert (keys_of(x) == keys_of(x[::-1].copy())).sum() < len(keys_of(x)) / 2


def brute(rows):
    """Classes by all pairs."""
    own = [(r[0], shingles(r[1])) for r in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(own)):
        for j in range(i):
            a, b = own[i][1], own[j][1]
            if a and b and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)):
                c = chain(a, b)
                if c >= 0.8 * (len(a) + len(b) - c):
                    root[find(i)] = find(j)
    least: dict = {}
    for k, r in enumerate(rows):
        f = find(k)
        least[f] = r[0] if least.get(f) is None else least[f] if r[0] is None else min(least[f], r[0])
    return [least[find(k)] if own[k][1] else rows[k][0] for k in range(len(rows))]


def hard_rows():
    rng = random.Random(4)
    rows = [r for r in documents(7, 20) if len(r[1] or "") < 3000]
    seed = prose(rng, EN, 90).split()
    passage = prose(rng, EN, 60)
    for k in range(30):  # near copies of one text
        w = list(seed)
        w[rng.randrange(len(w))] = f"edit{k}"
        rows.append((1000 + k, " ".join(w), "en", "s", 0))
    rows += [(2000 + k, " ".join(seed), "en", "s", 0) for k in range(10)]
    rows += [(3000 + k, passage + " " + prose(rng, EN, 80), "en", "s", 0) for k in range(25)]  # share a passage only
    rows += [(4000, "short one", "en", "s", 0), (4001, "Short  ONE!", "en", "s", 0)]
    return rows


def test_classes_equal_all_pairs(spark):
    rows = hard_rows()
    got = near_duplicates(frame(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"])) for r in got) == sorted((str(r[0]), str(c)) for r, c in zip(rows, brute(rows), strict=True))


def template_rows(share):
    """Pages of one template that differ in the rest; each two of them share a little more."""
    rng = random.Random(9)
    total = 300
    template = [f"t{k}" for k in range(round(share * total))]
    rows, own = [], total - len(template)
    for k in range(60):
        tail = [f"p{k}x{j}" for j in range(own)]
        rows.append((2 * k, " ".join(template + tail), "en", "s", 0))
        new = max(1, round(own - (0.91 - share) * total))
        rows.append((2 * k + 1, " ".join(template + tail[:own - new] + [f"q{k}x{j}" for j in range(new)]), "en", "s", 0))
    rng.shuffle(rows)
    return rows


def test_near_copies_among_pages_of_one_template(spark):
    for share in (0.8, 0.85, 0.87):
        rows = template_rows(share)
        own = labelled(pa.array([r[1] for r in rows]))
        want = [min(rows[j][0] for j, y in enumerate(own) if similarity(x, y) >= 0.8) for x in own]  # all pairs; a class is one step wide
        got = {r["doc_id"]: r["class_id"] for r in near_duplicates(frame(spark, rows)).collect()}
        assert got == {r[0]: c for r, c in zip(rows, want, strict=True)}, share
        assert len(set(want)) == 60


def test_rare_pairs_hold_every_pair_at_the_threshold(spark):
    rng = random.Random(11)
    pool = [f"w{k}" for k in range(60)]
    texts = [" ".join(x for x in pool if rng.random() > rng.choice([0.01, 0.02, 0.04])) for _ in range(50)]
    texts += [r[1] for r in template_rows(0.85)[:40]]
    x = [np.unique(v) for v in labelled(pa.array(texts))]
    near = {(a, b) for b in range(len(x)) for a in range(b) if (c := len(np.intersect1d(x[a], x[b]))) >= 0.8 * (len(x[a]) + len(x[b]) - c)}
    rows = spark.createDataFrame([(k, k, t) for k, t in enumerate(texts)], "num long, root long, text string")
    for common in (2, 8, 1000):
        got = {(r["a"], r["b"]) for r in rare_pairs(rows, 0.8, common).collect()}
        assert near and near <= got
    assert all(a < b for a, b in got)


def test_one_of_each_class_stays(spark):
    rows = hard_rows()
    df = clashing(frame(spark, rows))
    left = dedupe(df)
    assert left.columns == df.columns
    got = left.collect()
    want = collections.Counter(str(c) for r, c in zip(rows, brute(rows), strict=True) if shingles(r[1]))
    kept = collections.Counter(str(r[0]) for r in got if shingles(r[1]))
    assert set(kept) == set(want) and max(kept.values()) == 1
    assert sum(not shingles(r[1]) for r in got) == sum(not shingles(r[1]) for r in rows)


def test_large_id_tables_give_the_same_rows(spark, monkeypatch):
    rows = hard_rows()
    rows += [rows[0], rows[0], (None, *rows[0][1:])]
    df = frame(spark, rows)

    def found():
        classes = {(str(r["doc_id"]), r["class_id"], r["kept"]) for r in near_duplicates(df).collect()}
        return classes, collections.Counter(map(str, dedupe(df).collect()))

    want = found()
    monkeypatch.setattr(order_minhash, "BROADCAST_ROWS", 0)
    assert found() == want
    monkeypatch.setattr(order_minhash, "HASHED_ROWS", 0)
    assert found() == want


def test_hashes_name_every_row_that_may_meet(spark):
    rows = spark.createDataFrame([(f"n{k}",) for k in range(5000)] + [(None,)], "node string")
    some = spark.createDataFrame([(f"n{k}",) for k in range(0, 5000, 50)], "node string")
    hit = {r["node"] for r in order_minhash.with_hit(rows, ["node"], some).filter("_hit").collect()}
    assert hit == {f"n{k}" for k in range(0, 5000, 50)}
    assert order_minhash.with_hit(rows, ["node"], some.limit(0)).filter("_hit").count() == 0


def test_prefix_rows_are_not_broadcast(spark):
    texts = [r[1] for r in template_rows(0.85)[:40]]
    rows = spark.createDataFrame([(k, k, t) for k, t in enumerate(texts)], "num long, root long, text string")
    plan = rare_pairs(rows, 0.8, 2)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 103), (101, 103), (102, 103)]
    got = {r["num"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 104)}


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).count() == 0 and dedupe(frame(spark, [])).count() == 0
    assert near_duplicates(frame(spark, [(1, None, None, None, 0)])).collect()[0]["class_id"] == 1

import collections
import math
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as se
from quire.llm import log_bilinear as LB
from quire.llm.log_bilinear import score_texts
from tests.conftest import SF_SMALL
from tests.llm.fixtures import clashing, documents, frame

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def tokens(text):
    return WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())) + [None]


def fold(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5


def test_base_score_equals_brute_force(spark):
    docs = documents(9, 30)
    count = collections.Counter(w for d in docs if fold(d[0]) != 1 for w in tokens(d[1]))
    total, distinct = sum(count.values()), len(count)
    rows = score_texts(clashing(frame(spark, docs))).collect()
    want = sorted((str(d[0]), fold(d[0]) == 1, len(tokens(d[1])), sum(count[w] > 0 for w in tokens(d[1])), total,
                   round(sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens(d[1])), 6)) for d in docs)
    got = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)
    assert got == want


def test_model_beats_the_base_on_held_out_texts(spark):
    got = [r for r in se.queries()["op8_log_bilinear"](spark, SF_SMALL).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    assert all(r["score"] < 0 for r in got)


def model_of(n, seed=0, texts=5):
    """A model over n made-up symbols with random vectors."""
    rng = np.random.default_rng(seed)
    v = LB.Vocabulary.__new__(LB.Vocabulary)
    v.size = v.begin = n
    v.group(np.sort(rng.pareto(1.0, n) * 100 + 1)[::-1])
    m = LB.LogBilinear(v, seed)
    for p in m.PARTS:
        setattr(m, p, getattr(m, p) + rng.standard_normal(getattr(m, p).shape).astype(np.float32))
    return m


def formula(m, context):
    """Probabilities of all symbols, by hand."""
    h = sum(m.c[j].astype(float) * m.r[context[j]] for j in range(LB.CONTEXT))
    group = np.exp(m.g[:, :-1] @ h + m.g[:, -1])
    out = np.exp(m.q[:, :-1] @ h + m.q[:, -1])
    own = m.v.group_of
    return (group / group.sum())[own] * out / np.bincount(own, weights=out)[own]


@pytest.mark.parametrize("n", [1, 2, 65, 700])
def test_probabilities_sum_to_one_and_equal_the_formula(n):
    m = model_of(n)
    context = np.random.default_rng(3).integers(0, n + 1, LB.CONTEXT)
    lp = m.log10(np.tile(context, (n, 1)), np.arange(n))
    assert (10 ** lp).sum() == pytest.approx(1, abs=1e-5)
    assert lp == pytest.approx(np.log10(formula(m, context)), abs=1e-4)


def test_groups_are_ranges_and_their_number_follows_the_vocabulary():
    for n in (1, 3, 100, 10_000):
        v = model_of(n).v
        assert (np.diff(v.group_of) >= 0).all() and v.first[0] == 0 and v.first[-1] == n
        assert v.mass.sum() == pytest.approx(1) and np.bincount(v.group_of, weights=v.share) == pytest.approx(np.ones(len(v.mass)))
        assert 0.3 * n ** 0.5 <= len(v.mass) <= n ** 0.5 + 1


def test_steps_follow_the_gradient_of_both_losses():
    rng = np.random.default_rng(1)
    m = model_of(40)
    context, target = rng.integers(0, 41, (600, LB.CONTEXT)), rng.choice([3, 20, 33, 39], 600)
    before, seen = m.log10(context, target).mean(), {}
    for _ in range(60):
        m.step(context, target, np.random.default_rng(7), seen)
    assert m.log10(context, target).mean() > before + 0.3


def test_the_vocabulary_and_the_rounds_grow_with_the_tokens(spark):
    sizes = []
    for n in (30, 200):
        rows = frame(spark, documents(2, n)).select("doc_id", "text").toDF("id", "text")
        _, model = LB.fit(rows)
        sizes.append(model.v.size)
        assert model.v.size == min(round(model.v.total ** 0.5), len(model.v.common.keys)) + LB.TAILS + 1
    assert sizes[1] > sizes[0]
    assert [LB.rounds_of(10 ** k) for k in (0, 5, 6, 7, 9, 12)] == [1, 1, 2, 3, 5, 8]


def test_scores_equal_the_model_applied_by_hand(spark):
    docs = [(i, t, "", "", 0) for i, t in enumerate(["the red house is red", "", None, "the  unseen\tword RED", "a b a b a b", "the house"])]
    train = frame(spark, documents(1, 40) + docs[:1]).select("doc_id", "text").toDF("id", "text")
    counts, m = LB.fit(train)
    v = m.v
    count = {r["h"]: r["n"] for r in counts.collect()}
    rows = frame(spark, docs).selectExpr("doc_id as id", "text", "true as held_out")
    got = {r["id"]: r for r in LB.score_rows(rows, counts, m).collect()}
    for i, text, *_ in docs:
        words = tokens(text)[:-1]
        h, tail, _ = LB.tokens(LB.pa.array([text], LB.pa.string()))
        symbols = [int(x) for x in v.symbols(h, tail)] + [v.end]
        history, total = [v.begin] * LB.CONTEXT, 0.0
        for k, s in enumerate(symbols):
            total += math.log10(formula(m, history[-LB.CONTEXT:])[s])
            if k < len(words) and s in set(v.tail_symbol.tolist()):
                c = count.get(int(h[k:k + 1].view(np.int64)[0]), 0)
                total += math.log10((c + 0.5) / (v.tail_n[tail[k]] + 0.5 * (v.tail_v[tail[k]] + 1)))
            history.append(s)
        assert got[i]["score"] == pytest.approx(total, abs=2e-3) and got[i]["n_tokens"] == len(symbols)


def test_words_beyond_the_broadcast_counts_are_joined(spark, monkeypatch):
    docs = documents(6, 30)
    want = {(str(r["doc_id"]), r["n_tokens"]): r for r in score_texts(frame(spark, docs)).collect()}
    monkeypatch.setattr(LB, "COMMON", 200)
    for r in score_texts(frame(spark, docs)).collect():
        w = want[str(r["doc_id"]), r["n_tokens"]]
        assert r["n_known"] == w["n_known"] and r["base_score"] == pytest.approx(w["base_score"], abs=1e-6)


def test_empty_and_untrained(spark):
    assert score_texts(frame(spark, [])).count() == 0
    held = next(i for i in range(100) if fold(i) == 1)
    r = score_texts(frame(spark, [(held, "never seen", "en", "s", 0)])).collect()[0]
    assert (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, pytest.approx(0))

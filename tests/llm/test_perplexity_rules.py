import collections
import math
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import perplexity_rules as P
from tests.llm.fixtures import clashing, documents, frame

TEXT = st.text(alphabet="ab \n\t\x0b#|<é ", max_size=60)


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    c = collections.Counter(zip(w, w[1:], w[2:]))
    inside = {k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=6))
def test_base_counts_equal_brute_force(texts):
    got = zip(*[x.tolist() for x in P.base_counts(pa.array(texts, pa.string()))], strict=True)
    assert list(got) == [base(t) for t in texts]


def kneser_ney(texts):
    """Plain modified Kneser-Ney of character trigrams; returns p(c | a b)."""
    c3 = collections.Counter(s[i:i + 3] for t in texts for s in ["\n" + t + "\n"] for i in range(len(s) - 2))
    c2 = collections.Counter(g[1:] for g in c3)
    c1 = collections.Counter(g[1] for g in c2)

    def order(counts, cut):
        n = [sum(v == k for v in counts.values()) for k in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
        d = [0.0] + [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0), k) if y is not None and n[k] else 0.75 for k in (1, 2, 3)]
        total = collections.Counter()
        for g, v in counts.items():
            total[g[:cut]] += v
        p = {g: max(v - d[min(v, 3)], 0) / total[g[:cut]] for g, v in counts.items()}
        left = collections.Counter()
        for g, v in p.items():
            left[g[:cut]] += v
        return p, {h: 1 - left[h] for h in total}

    p1, b1 = order(c1, 0)
    p2, b2 = order(c2, 1)
    p3, b3 = order(c3, 2)

    def prob(g):
        p = p1.get(g[2], 0) + b1[""] / 0x110000
        p = p2.get(g[1:], 0) + b2.get(g[1], 1) * p
        return p3.get(g, 0) + b3.get(g[:2], 1) * p

    return prob


@pytest.mark.parametrize("max_entries", [P.MAX_ENTRIES, 3000, 300])
def test_perplexity_equals_plain_kneser_ney(spark, max_entries):
    docs = [d for d in documents(5, 30) if d[0] is not None]
    rows = P.quality_rules(frame(spark, docs), max_entries=max_entries).collect()
    assert len(rows) == len(docs)
    prob = {x: kneser_ney([d[1] or "" for d in docs if (d[2] or "") == x]) for x in {d[2] or "" for d in docs}}
    by = {(d[0], base(d[1])): d for d in docs}
    for r in rows:
        d = by[r["doc_id"], (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])]
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed
        s = "\n" + (d[1] or "") + "\n"
        grams = [s[i:i + 3] for i in range(len(s) - 2)]
        if not grams:
            assert r["log_ppl"] is None and not r["kept"]
            continue
        want = -sum(math.log10(prob[d[2] or ""](g)) for g in grams) / len(grams)
        assert r["log_ppl"] == pytest.approx(want, rel=1e-9)
        assert r["kept"] == (not failed and r["low"] <= r["log_ppl"] <= r["high"])


def test_a_model_over_the_bound_is_dealt_out_whole(spark):
    import numpy as np

    rows = frame(spark, documents(5, 10)).selectExpr("text", "coalesce(lang, '') as lang")
    tables, scans = P.fit(rows, max_entries=300)
    assert any(p.shards > 1 for p in scans)
    alphabet = np.arange(0x110000)
    for lang in {x for p in scans for x in p.langs}:
        own = [p for p in scans if lang in p.langs]
        parts = [P.load(tables, p)[lang] for p in own]
        n = [len(m.tables["p3"][0]) for m in parts]
        assert sum(n) == tables.filter((tables.part == "p3") & (tables.lang == lang)).count() and max(n) <= 600
        for a, b in ("th", "nd", "qq"):
            context = ord(a) << 21 | ord(b)
            m = next(m for p, m in zip(own, parts) if context % p.shards == p.shard)
            assert (10 ** m.log10(context << 21 | alphabet)).sum() == pytest.approx(1, abs=1e-6)


def test_scans_hold_every_language_once():
    got = P.passes([("a", 10), ("b", 50), ("c", 250), ("d", 60), ("e", 100)], 100)
    assert got == [P.Pass(["a", "b"]), P.Pass(["c"], 0, 3), P.Pass(["c"], 1, 3), P.Pass(["c"], 2, 3), P.Pass(["d"]), P.Pass(["e"])]
    assert P.passes([], 100) == []


def test_bands_reject_odd_texts_of_their_language(spark):
    docs = [d for d in documents(6, 90) if d[0] is not None and d[0] < 90 and len((d[1] or "").split()) >= 50]
    odd = [(1000, " ".join(f"%%{k}x$$" for k in range(80)), "en", "s", 0)]
    rows = {r["doc_id"]: r for r in P.quality_rules(clashing(frame(spark, docs + odd))).collect()}
    assert not rows[1000]["base_failed"] and not rows[1000]["kept"]
    assert sum(rows[d[0]]["kept"] for d in docs) >= 0.9 * len(docs)


def test_empty_table(spark):
    assert P.quality_rules(frame(spark, [])).count() == 0
    assert [r["kept"] for r in P.quality_rules(frame(spark, [(1, None, None, None, 0)])).collect()] == [False]

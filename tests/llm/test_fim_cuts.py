import hashlib
import random
import re

import numpy as np
import pytest

from quire.llm import fim_cuts as FC
from tests.llm.fixtures import clashing, documents, frame


def brute(doc_id, text, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    form = "spm" if h[3] % 100 < spm_rate else "psm"
    return n, form, len(a), len(b), f"<S>{c}<P>{a}<M>{b}" if form == "spm" else f"<P>{a}<S>{c}<M>{b}"


@pytest.mark.parametrize("seed", range(6))
def test_select_equals_the_sorted_offsets(seed):
    rng = np.random.default_rng(seed)
    sets = [rng.choice(1 << 20, 5000, replace=False), rng.choice(1 << 17, 60_000, replace=False), np.arange(70_000, 200_000),
            np.array([0]), np.array([65_535, 65_536]), np.zeros(0, np.int64), np.r_[np.arange(100), rng.choice(1 << 18, 30_000)]]
    kinds = set()
    for x in sets:
        x = np.unique(x)
        s = FC.BoundarySet(x)
        kinds |= {c.kind for c in s.containers}
        assert len(s) == len(x)
        ranks = rng.integers(0, len(x), 500) if len(x) else np.zeros(0, np.int64)
        assert (s.select(ranks) == x[ranks]).all() and (s.select(np.arange(len(x))) == x).all()
    assert kinds == {FC.ARRAY, FC.BITMAP, FC.RUN}


HARD = [(900, "\n" * 70_000, None, None, None), (901, "<S", None, None, None), (902, "a<P>b\n", None, None, None), (903, "ä\nö\n日本\n😀", None, None, None),
        (904, "x", None, None, None), (905, "\n", None, None, None), (906, "a<\n<\n>S>\n<", None, None, None), (907, "y " * 200_000 + "\n" + "z\n" * 90_000, None, None, None)]


def rows_of(df):
    return sorted(((r["doc_id"], r["text"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("rate,spm_rate", [(100, 50), (60, 0), (0, 50), (100, 100)])
def test_equals_brute_force(spark, rate, spm_rate):
    docs = documents(3) + HARD
    got = rows_of(FC.transform(frame(spark, docs), rate=rate, spm_rate=spm_rate))
    want = []
    for d in docs:
        n, form, a, b, out = brute(d[0], d[1], rate, spm_rate)
        want.append((d[0], d[1], n, form, a, b, out))
    assert got == sorted(want, key=repr)


def test_exact_round_trip_and_clashing_columns(spark):
    df = clashing(frame(spark, documents(5) + HARD))
    back = FC.restore(FC.transform(df))
    assert back.columns == [*df.columns, "n", "prefix_chars", "middle_chars", "form", "output", "restored"]
    cut = back.toDF(*[f"x{i}" for i in range(len(back.columns))])
    assert cut.filter(f"x{len(back.columns) - 1} <> coalesce(x1, '')").count() == 0
    assert cut.count() == df.count()


def test_any_text_round_trips(spark):
    rng = random.Random(1)
    docs = [(i, "".join(rng.choice(["<", ">", "P", "S", "M", "\n", "é", "a"]) for _ in range(rng.randint(0, 40))), None, None, None) for i in range(400)]
    back = FC.restore(FC.transform(frame(spark, docs)))
    assert back.filter("restored <> text").count() == 0
    assert {r["form"] for r in back.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert FC.digests(frame(spark, [])).count() == 0

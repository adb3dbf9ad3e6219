import collections
import re
import zlib

import numpy as np

import __spark_entry__ as se
from quire.llm.hyper_lang import Alphabet, bind, identify, keep_known, letter_vectors, trigrams
from tests.conftest import SF_SMALL
from tests.llm.fixtures import clashing, documents, frame


def brute(text):
    s = "".join(c.lower()[0] if c.isalpha() else " " for c in f" {text or ''} ")
    s = re.sub(" +", " ", s)
    return collections.Counter(s[i:i + 3] for i in range(len(s) - 2)) if s.strip() else collections.Counter()


def test_trigrams_equal_brute_force():
    texts = ["Abc d", None, "", "12", "é!ß", "a", "日本語 text", "x\ny", "A-B"]
    known, code, row = trigrams(texts, Alphabet())
    for k, t in enumerate(texts):
        own = collections.Counter("".join(chr(v) if v else " " for v in (g >> 42, g >> 21 & 0x1FFFFF, g & 0x1FFFFF)) for g in known[code[row == k]])
        assert own == brute(t), t


def test_binding_rotates_and_multiplies():
    letters = np.array([0, ord("a"), ord("b")])
    base = letter_vectors(letters, 256)
    got = bind(np.array([(ord("a") << 42) | (ord("b") << 21)]), 256)[0]
    assert (got == np.roll(base[1], 2) * np.roll(base[2], 1) * base[0]).all()


def test_prediction_is_the_nearest_prototype_by_cosine(spark):
    docs = documents(4, 40)
    got = {(r["doc_id"], r["text"]): r for r in identify(frame(spark, docs)).collect()}
    fold = {d[0]: zlib.crc32(("" if d[0] is None else str(d[0])).encode()) % 5 for d in docs}

    def vector(counts):
        packed = np.array([(ord(a) if a != " " else 0) << 42 | (ord(b) if b != " " else 0) << 21 | (ord(c) if c != " " else 0) for a, b, c in counts], np.int64)
        return np.array(list(counts.values())) @ bind(packed, 1024).astype(float) if len(counts) else np.zeros(1024)

    proto = {x: sum((vector(brute(d[1])) for d in docs if d[2] == x and fold[d[0]]), np.zeros(1024)) for x in ("de", "en")}
    for d in docs:
        r, v = got[d[0], d[1]], vector(brute(d[1]))
        assert r["held_out"] == (fold[d[0]] == 0)
        if not v.any():
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        cos = {x: float(p @ v / np.linalg.norm(p) / np.linalg.norm(v)) for x, p in proto.items()}
        best = max(cos, key=cos.get)
        assert r["lang_pred"] == best and abs(r["score"] - max(cos[best], 0)) < 1e-4


def test_held_out_accuracy(spark):
    got = se.queries()["op7_language_id"](spark, SF_SMALL)
    lang = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    held = got.join(lang, "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95


def test_stage_drops_only_texts_without_letters(spark):
    df = clashing(frame(spark, documents(4, 20)))
    left = keep_known(df)
    assert left.columns == df.columns
    want = [d for d in documents(4, 20) if d[1] and any(c.isalpha() for c in d[1])]
    assert left.count() == len(want)


def test_empty_and_untrained(spark):
    assert identify(frame(spark, [])).count() == 0
    rows = identify(frame(spark, [(1, "no language here", None, "s", 0)])).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows] == [("und", 0.0)]

"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, derived from its code point.
A letter trigram is bound by multiplying the vectors of its letters, the first
rotated by two places, the second by one; a text's vector bundles (adds) its
trigrams, a language's prototype bundles the trigrams of all its training
texts. A document gets the language whose prototype has the largest cosine
with its vector.

Bundling is linear, so a prototype needs only the language's trigram counts:
Spark counts them over all training texts (numpy per batch, then a sum by
language and trigram), binds each trigram once and adds the vectors up. What
reaches the driver is one vector per language.

Letters are compared in lower case; everything else (digits, marks, spaces)
is one boundary symbol, runs of it count once. A text that is null or has no
letter gets ``und`` and score 0, and so does every text when there is no
training text. Rows with a null language or a null text train nothing. Equal
cosines go to the first language in code-point order. The score is the
cosine, cut to 0..1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import code_points, compact_trigrams, fold, mix64, place, positional, row_of, slices

DIM = 1024
UNKNOWN = "und"
#: Cells of the (text, trigram) count matrix of one matrix product.
COUNT_CELLS = 1 << 20
_BITS = 21


class Alphabet:
    """Code point -> lower-cased letter, 0 for anything else; filled as code points appear."""

    def __init__(self):
        self.to = np.full(0x110000, -1, np.int32)

    def __call__(self, cps: np.ndarray) -> np.ndarray:
        seen = np.zeros(0x110000, bool)
        seen[cps] = True
        for c in np.flatnonzero(seen & (self.to < 0)):
            x = chr(c)
            self.to[c] = ord(x.lower()[0]) if x.isalpha() else 0
        return self.to[cps]


def trigrams(texts: list[str | None], letters: Alphabet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct packed trigrams, index into them and row of every trigram of the
    texts, rows ascending)."""
    cps, first = code_points(texts)
    sym = letters(cps)
    pos = np.flatnonzero(np.r_[True, (sym[1:] != 0) | (sym[:-1] != 0)])
    sym, row = sym[pos], row_of(texts, first)[pos]
    if len(sym) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b, c = sym[:-2] != 0, sym[1:-1] != 0, sym[2:] != 0
    ok = b | a & c & (row[:-2] == row[2:])
    known, code = compact_trigrams(sym, ok)
    return known, code, np.where(b, row[1:-1], row[2:])[ok]


def letter_vectors(letters: np.ndarray, dim: int) -> np.ndarray:
    """One row of +1 / -1 per letter, a function of code point and place alone."""
    words = mix64(letters.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(dim // 64, dtype=np.uint64) + np.uint64(1))
    bits = np.unpackbits(words.astype("<u8").view(np.uint8), axis=1)
    return (bits.astype(np.int8) * 2 - 1)


def bind(grams: np.ndarray, dim: int) -> np.ndarray:
    """Vectors of packed trigrams."""
    mask = (1 << _BITS) - 1
    parts = [(grams >> 2 * _BITS) & mask, (grams >> _BITS) & mask, grams & mask]
    letters = np.unique(np.concatenate(parts)) if len(grams) else np.zeros(0, np.int64)
    base = letter_vectors(letters, dim)
    out = np.roll(base, 2, axis=1)[np.searchsorted(letters, parts[0])]
    out *= np.roll(base, 1, axis=1)[np.searchsorted(letters, parts[1])]
    out *= base[np.searchsorted(letters, parts[2])]
    return out


def prototypes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dim: int = DIM) -> dict[str, np.ndarray]:
    """{language: bundled vector} of all training rows."""

    def count(batches):
        letters = Alphabet()
        for b in batches:
            for first, end in slices(b.column(0)):
                known, code, row = trigrams(b.column(0).slice(first, end - first).to_pylist(), letters)
                langs = b.column(1).slice(first, end - first).dictionary_encode()
                lang_of = np.asarray(langs.indices)[row]
                for k, lang in enumerate(langs.dictionary.to_pylist()):
                    n = np.bincount(code[lang_of == k], minlength=len(known))
                    own = np.flatnonzero(n)
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(own), pa.string()), "gram": known[own], "n": n[own].astype(np.int64)})

    def bundle(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b.column(0).dictionary_encode()
            code = np.asarray(langs.indices)
            gram, n = b.column(1).to_numpy(), b.column(2).to_numpy()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                for at in np.array_split(np.flatnonzero(code == k), 1 + len(code) // 4096):
                    total[lang] = total.get(lang, 0) + n[at].astype(np.float64) @ bind(gram[at], dim)
        for lang, v in total.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * dim, pa.string()), "place": np.arange(dim, dtype=np.int32), "v": v})

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    counts = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    sums = counts.mapInArrow(bundle, "lang string, place int, v double").groupBy("lang", "place").agg(F.sum("v").alias("v"))
    per = sums.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "v"))), lambda x: x["v"]).alias("v"))
    return {r["lang"]: np.array(r["v"]) for r in per.orderBy("lang").collect()}


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """``docs`` with the columns ``lang_pred`` and ``score`` added at the end."""
    langs = sorted(profiles)
    dim = len(profiles[langs[0]]) if langs else DIM
    unit = [profiles[x] / (np.linalg.norm(profiles[x]) or 1.0) for x in langs]
    sent = docs.sparkSession.sparkContext.broadcast((langs, np.array(unit, np.float32).reshape(len(langs), dim)))
    at = docs.columns.index(text_col)

    def cosines(texts, letters, proto):
        """(best language, cosine) of every text; -1 without letters."""
        best, score = np.full(len(texts), -1), np.zeros(len(texts))
        known, code, row = trigrams(texts, letters)
        if not len(known) or not len(proto):
            return best, score
        vectors = np.concatenate([bind(known[i:i + 8192], dim).astype(np.float32) for i in range(0, len(known), 8192)])
        step = max(1, COUNT_CELLS // len(known))
        cut = np.searchsorted(row, np.arange(0, len(texts) + step, step))
        for k, d in enumerate(range(0, len(texts), step)):
            own = slice(cut[k], cut[k + 1])
            n = min(step, len(texts) - d)
            counts = np.bincount((row[own] - d) * len(known) + code[own], minlength=n * len(known))
            v = counts.reshape(n, len(known)).astype(np.float32) @ vectors
            cos = v @ proto.T / np.maximum(np.linalg.norm(v, axis=1), 1e-9)[:, None]
            top = np.argmax(cos, axis=1)
            there = np.bincount(row[own] - d, minlength=n) > 0
            best[d:d + n] = np.where(there, top, -1)
            score[d:d + n] = np.where(there, np.clip(cos[np.arange(n), top], 0, 1), 0)
        return best, score

    def run(batches):
        letters = Alphabet()
        names, proto = sent.value
        names = np.array([*names, UNKNOWN], object)
        for b in batches:
            for first, end in slices(b.column(at), 2 << 20):
                own = b.slice(first, end - first)
                best, score = cosines(own.column(at).to_pylist(), letters, proto)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(names[best], pa.string()), pa.array(score)],
                                                 names=[*own.schema.names, "lang_pred", "score"])

    plain = positional(docs)
    schema = T.StructType([*plain.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return plain.mapInArrow(run, schema).toDF(*docs.columns, "lang_pred", "score")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", dim: int = DIM) -> DataFrame:
    """Learn from the rows outside fold 0 and predict every row: ``docs`` with
    ``held_out``, ``lang_pred`` and ``score``."""
    held = fold(id_col) == 0
    profiles = prototypes(docs.filter(~held), text_col, lang_col, dim)
    return predict(docs.withColumn("held_out", held), profiles, text_col)


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", dim: int = DIM) -> DataFrame:
    """``docs`` without the rows of unknown language (no text or no letter), columns unchanged."""
    profiles = prototypes(docs.filter(fold(id_col) != 0), text_col, lang_col, dim)
    found = predict(positional(docs), profiles, place(docs, text_col))
    return found.filter(F.col("lang_pred") != UNKNOWN).drop("lang_pred", "score").toDF(*docs.columns)

"""Quality rules: counted base rules and language-specific perplexity bands.

The language model is a modified Kneser-Ney model of character trigrams, one
per language. Spark counts the trigrams of all texts (numpy per batch, then a
sum by language and trigram); discounts, continuation counts and back-off
weights are DataFrame aggregates of that count table. A language's model is
three pairs of arrays (sorted 64-bit hashes of the n-grams, their values), so
a lookup is a binary search for the n-grams a batch really holds.

Texts are scored by their own language's model. Per language, the median and
the median absolute deviation of the log10 perplexities give a lower and an
upper bound (``band`` scaled deviations off the median); a text outside is
rejected. Both are read from a histogram with bins of 0.001, so no group of
scores is ever gathered.

Counts cover code points as they are, case included. A text is read between
two line feeds, each of its characters but the first predicted from the two
before. A null language is a group of its own. A null or empty text has no
words, fails the base rules and has a null perplexity; rows with equal ids or
texts are counted and judged one by one. Ties at a bound are kept.

A model sent to the executors holds about ``max_entries`` trigrams at most:
several languages share a broadcast up to that bound and are scored in as many
scans as there are broadcasts. The trigrams of a language with more are dealt
out by their context over several scans of its texts, whose sums add up; no
trigram is left out. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.common import (SPACED, code_points, compact_trigrams, hash_spans, mix64, row_of, slices, text_bytes,
                              word_spans, written)

BAND = 4.0
#: Least half-width of a band, in bins of 0.001 of log10 perplexity.
MIN_WIDTH = 40
MAX_ENTRIES = 4_000_000
MAX_LANGS = 100_000
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_MASK21, _MASK42 = (1 << 21) - 1, (1 << 42) - 1
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct packed trigrams, index into them, row) of every scored position."""
    cps, first = code_points(texts)
    if len(cps) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = row_of(texts, first)
    ok = row[1:-1] == row[2:]
    known, code = compact_trigrams(cps, ok)
    return known, code, row[2:][ok]


def count_trigrams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (text, lang)."""

    def count(batches):
        for b in batches:
            for first, end in slices(b.column(0)):
                known, code, row = trigrams(b.column(0).slice(first, end - first).to_pylist())
                langs = b.column(1).slice(first, end - first).dictionary_encode()
                lang_of = np.asarray(langs.indices)[row]
                for k, lang in enumerate(langs.dictionary.to_pylist()):
                    n = np.bincount(code[lang_of == k], minlength=len(known))
                    own = np.flatnonzero(n)
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(own), pa.string()), "gram": known[own], "n": n[own].astype(np.int64)})

    return docs.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def few(per_lang: DataFrame, langs: int) -> DataFrame:
    """A table of one short row a language, to be broadcast if there are at most
    ``MAX_LANGS`` languages: a join by language would meet a whole language in one task."""
    return F.broadcast(per_lang) if langs <= MAX_LANGS else per_lang


def discounted(counts: DataFrame, context, langs: int) -> tuple[DataFrame, DataFrame]:
    """Modified Kneser-Ney at one order, from (lang, gram, n): the n-grams' discounted
    probabilities (lang, gram, value) and the contexts' back-off weights (lang, gram, value)."""
    of = [F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    rate = [F.coalesce(k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}")), F.lit(0.75)) for k in (1, 2, 3)]
    rate = [F.greatest(F.lit(0.0), F.least(F.lit(float(k)), r)) for k, r in enumerate(rate, 1)]
    rates = counts.groupBy("lang").agg(*of).select("lang", *[r.alias(f"d{k}") for k, r in enumerate(rate, 1)])
    rows = counts.withColumn("context", context)
    total = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"))
    rows = rows.join(few(rates, langs), "lang").join(total, ["lang", "context"])
    d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = rows.withColumn("value", F.greatest(F.col("n") - d, F.lit(0.0)) / F.col("total"))
    weights = rows.groupBy("lang", "context").agg((1 - F.sum("value")).alias("value"))
    return rows.select("lang", "gram", "value"), weights.select("lang", F.col("context").alias("gram"), "value")


class Model:
    """One language: n-gram hashes and values of three orders and two back-off tables."""

    def __init__(self, tables: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.tables = {}
        for name, (gram, value) in tables.items():
            key = mix64(gram.astype(np.uint64))
            order = np.argsort(key)
            self.tables[name] = key[order], value[order].astype(np.float64)
        self.floor = max(0.0, 1.0 - float(self.tables["p1"][1].sum())) / 0x110000

    def get(self, name: str, gram: np.ndarray, missing: float) -> np.ndarray:
        key, value = self.tables[name]
        if not len(key):
            return np.full(len(gram), missing)
        h = mix64(gram.astype(np.uint64))
        at = np.minimum(np.searchsorted(key, h), len(key) - 1)
        return np.where(key[at] == h, value[at], missing)

    def log10(self, gram: np.ndarray) -> np.ndarray:
        """log10 probability of the last symbol of each trigram given the other two."""
        p = self.get("p1", gram & _MASK21, 0.0) + self.floor
        p = self.get("p2", gram & _MASK42, 0.0) + self.get("b2", (gram >> 21) & _MASK21, 1.0) * p
        return np.log10(self.get("p3", gram, 0.0) + self.get("b3", gram >> 21, 1.0) * p)


PARTS = ("p3", "b3", "p2", "b2", "p1")


class Pass(NamedTuple):
    """One scan of the texts of some languages with what fits a broadcast: their whole models,
    or of one large language the trigrams whose context has remainder ``shard``."""
    langs: list[str]
    shard: int = 0
    shards: int = 1


def passes(sizes: list[tuple[str, int]], max_entries: int) -> list[Pass]:
    """Scans for languages of the given numbers of trigrams."""
    out, filled = [], max_entries
    for lang, k in sorted(sizes):
        if k > max_entries:
            shards = -(-k // max_entries) | 1  # odd, so that both letters of a context tell
            out += [Pass([lang], j, shards) for j in range(shards)]
            filled = max_entries
            continue
        if filled + k > max_entries:
            out.append(Pass([]))
            filled = 0
        out[-1].langs.append(lang)
        filled += k
    return out


def fit(docs: DataFrame, max_entries: int = MAX_ENTRIES) -> tuple[DataFrame, list[Pass]]:
    """The models of all languages as one table (part, lang, gram, value), and the scans that
    send them, each with about ``max_entries`` trigrams at most."""
    c3 = written(count_trigrams(docs), "trigrams")
    sizes = [(r["lang"], r["k"]) for r in c3.groupBy("lang").agg(F.count(F.lit(1)).alias("k")).collect()]
    c2 = written(c3.groupBy("lang", F.col("gram").bitwiseAND(F.lit(_MASK42)).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "bigrams")
    c1 = c2.groupBy("lang", F.col("gram").bitwiseAND(F.lit(_MASK21)).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    n = len(sizes)
    tables = (*discounted(c3, F.shiftright("gram", 21), n), *discounted(c2, F.shiftright("gram", 21), n), discounted(c1, F.lit(0).cast("long"), n)[0])
    named = [t.select(F.lit(part).alias("part"), "lang", "gram", "value") for part, t in zip(PARTS, tables, strict=True)]
    return written(reduce(DataFrame.unionByName, named), "kneser-ney"), passes(sizes, max_entries)


def load(tables: DataFrame, p: Pass) -> dict[str, Model]:
    """The models of a scan."""
    context = F.when(F.col("part") == "p3", F.shiftright("gram", 21)).when(F.col("part") == "b3", F.col("gram")).otherwise(F.lit(p.shard))
    rows = tables.filter(F.col("lang").isin(p.langs) & (context % p.shards == p.shard)).toArrow()

    def of(lang: str, part: str):
        own = rows.filter(pc.and_(pc.equal(rows["lang"], lang), pc.equal(rows["part"], part)))
        return own["gram"].to_numpy(), own["value"].to_numpy()

    return {x: Model({part: of(x, part) for part in PARTS}) for x in p.langs}


def base_counts(col: pa.Array) -> list[np.ndarray]:
    """The columns of ``BASE`` for each row of a text column."""
    raw, off = text_bytes(col)
    data = np.frombuffer(raw.tobytes().translate(SPACED), np.uint8)
    starts, ends, before = word_spans(data, off)
    n = len(off) - 1

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(flags)]
        return total[off[1:]] - total[off[:-1]]

    words = np.diff(before)
    chars = per_row((data != 32) & ((data & 0xC0) != 0x80))
    symbols = per_row(_SYMBOLS[raw])

    # lines with a word, told apart by hash within their row
    cut = np.zeros(len(raw) + 1, bool)
    cut[off] = True
    cut[np.flatnonzero(raw == 10) + 1] = True
    line = np.flatnonzero(cut)
    first, end = line[:-1], line[1:]
    end = end - (raw[np.maximum(end - 1, 0)] == 10)
    has = np.searchsorted(starts, end) > np.searchsorted(starts, first)
    first, end = first[has], end[has]
    row = np.searchsorted(off, first, side="right") - 1
    _, at = np.unique(mix64(hash_spans(raw, first, end) ^ mix64(row.astype(np.uint64))), return_index=True)
    dup = np.bincount(row, minlength=n) - np.bincount(row[at], minlength=n)

    # words inside a window of three that its row has twice
    repeat = np.zeros(n, np.int64)
    if len(starts) >= 3:
        h = hash_spans(data, starts, ends)
        row = np.repeat(np.arange(n), words)
        ok = np.flatnonzero(row[:-2] == row[2:])
        key = mix64(mix64(mix64(h[ok] ^ mix64(row[ok].astype(np.uint64))) + h[ok + 1]) + h[ok + 2])
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order] = np.r_[same, False] | np.r_[False, same] if len(key) else False
        inside = np.zeros(len(starts), bool)
        for k in range(3):
            inside[ok[twice] + k] = True
        repeat = np.bincount(row[inside], minlength=n)
    return [x.astype(np.int64) for x in (words, chars, symbols, dup, repeat)]


def score(rows: DataFrame, tables: DataFrame, scans: list[Pass]) -> DataFrame:
    """``rows`` (id, text, lang) as id, lang, ``BASE`` and log_ppl (mean negative log10 probability)."""
    counted = [x.split()[0] for x in BASE.split(", ")]
    whole = [p for p in scans if p.shards == 1] or [Pass([])]
    others = sorted({x for p in scans if p not in whole[:1] for x in p.langs})
    parts = []
    for k, p in enumerate(whole):
        # the first scan also takes the languages without a trigram
        own = F.col("lang").isin(p.langs) if k else ~F.col("lang").isin(others)
        parts.append(scan(rows.filter(own).withColumn("num", F.lit(None).cast("long")), tables, p).drop("num"))
    for lang in sorted({p.langs[0] for p in scans if p.shards > 1}):
        own = written(rows.filter(F.col("lang") == lang).withColumn("num", F.monotonically_increasing_id()), "large-language")
        each = reduce(DataFrame.unionByName, [scan(own, tables, p) for p in scans if p.langs == [lang]])
        sums = each.groupBy("num").agg(F.any_value("id").alias("id"), F.any_value("lang").alias("lang"), *[F.sum(c).alias(c) for c in [*counted, "total"]], F.max("n").alias("n"))
        parts.append(sums.drop("num"))
    found = reduce(DataFrame.unionByName, parts)
    return found.select("id", "lang", *counted, F.when(F.col("n") > 0, -F.col("total") / F.col("n")).alias("log_ppl"))


def scan(rows: DataFrame, tables: DataFrame, p: Pass) -> DataFrame:
    """num, id, lang, ``BASE`` (0 but in the first shard), total log10 probability of the
    positions whose context is in the shard, and n, the scored positions of the text."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    sent = rows.sparkSession.sparkContext.broadcast(load(tables, p))
    names = ["num", "id", "lang", *[x.split()[0] for x in BASE.split(", ")], "total", "n"]

    def run(batches):
        model = sent.value
        for b in batches:
            for first, end in slices(b.column(1)):
                own = b.slice(first, end - first)
                known, code, row = trigrams(own.column(1).to_pylist())
                langs = own.column(2).dictionary_encode()
                lang_of = np.asarray(langs.indices)
                here = (known >> 21) % p.shards == p.shard
                lp = np.zeros((len(langs.dictionary), len(known)))
                for k, x in enumerate(langs.dictionary.to_pylist()):
                    if x in model:
                        lp[k, here] = model[x].log10(known[here])
                n = np.bincount(row, minlength=end - first)
                total = np.bincount(row, weights=lp[lang_of[row], code], minlength=end - first)
                base = base_counts(own.column(1)) if p.shard == 0 else [np.zeros(end - first, np.int64)] * 5
                yield pa.RecordBatch.from_arrays([own.column(3), own.column(0), own.column(2), *map(pa.array, base), pa.array(total.astype(np.float64)), pa.array(n.astype(np.int64))], names=names)

    return rows.mapInArrow(run, f"num long, id {kinds['id']}, lang {kinds['lang']}, {BASE}, total double, n long")


def middle(hist: DataFrame, name: str) -> DataFrame:
    """Per language the first bin that has half of the weight at or below it."""
    run = W.partitionBy("lang").orderBy("bin")
    rows = hist.withColumn("_sum", F.sum("k").over(run)).withColumn("_all", F.sum("k").over(W.partitionBy("lang")))
    return rows.filter(2 * F.col("_sum") >= F.col("_all")).groupBy("lang").agg(F.min("bin").alias(name))


def bands(scored: DataFrame, band: float = BAND, min_width: int = MIN_WIDTH) -> DataFrame:
    """(lang, low, high) of log10 perplexity, from the rows that pass the base rules."""
    bins = scored.filter(F.col("log_ppl").isNotNull() & ~F.col("base_failed")).select("lang", F.round(F.col("log_ppl") * 1000).cast("long").alias("bin"))
    hist = bins.groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("k"))
    mid = middle(hist, "mid")
    off = hist.join(mid, "lang").groupBy("lang", F.abs(F.col("bin") - F.col("mid")).alias("bin")).agg(F.sum("k").alias("k"))
    width = F.greatest(F.lit(float(min_width)), band * 1.4826 * F.col("dev"))
    return mid.join(middle(off, "dev"), "lang").select("lang", ((F.col("mid") - width) / 1000).alias("low"), ((F.col("mid") + width) / 1000).alias("high"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  band: float = BAND, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """Per document: id, the base counts, base_failed, log_ppl, low, high, kept."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"))
    tables, scans = fit(rows.select("text", "lang"), max_entries)
    scored = score(rows, tables, scans)
    scored = written(scored.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))), "scored")
    limits = written(bands(scored, band), "bands")
    out = scored.join(few(limits, len({x for p in scans for x in p.langs})), "lang", "left")
    kept = ~F.col("base_failed") & F.coalesce(F.col("log_ppl").between(F.col("low"), F.col("high")), F.lit(False))
    return out.select(F.col("id").alias(id_col), *[x.split()[0] for x in BASE.split(", ")], "base_failed", "log_ppl", "low", "high", kept.alias("kept"))

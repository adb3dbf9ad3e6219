"""Mixing sources to target weights, in DataFrame expressions only.

A document's size is its number of words. A source's target is its share of
all sizes by weight, but at most ``max_rate`` times its own size; what a
capped source leaves is shared again among the others by weight. The rate is
target / size of the source; every document is emitted floor(rate) times, and
once more when a hash of its id falls below the fraction of the rate, so a
rerun emits the same copies and no document needs to know another.

Source sizes come from one partial aggregate (a hot source is one row a task).
The capped shares have a closed form: with sources ordered by cap / weight,
the first k are capped, and the water level of the rest follows from running
sums over the small table of sources.

Weights are given to the sources in code-point order, null last, in turn.
A null source is a source of its own. A null or empty text has size 0 and
takes nothing from a target, but is copied like any other document of its
source; a source of size 0 has rate 0, so its documents are not emitted. Rows
with equal ids get equal draws; a null id draws as empty text. An empty table
gives an empty mix. Other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.common import place, positional, written

WEIGHTS = (5, 2, 1)
MAX_RATE = 3
#: A table of sources up to this many bytes is broadcast; a larger one is joined by a shuffle.
BROADCAST_BYTES = 4 << 20


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(id_col: str, seed: str) -> Column:
    """Uniform in [0, 1) from 52 bits of the md5 of seed and id."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """(source, source_size, target) of a table (source, size). The windows run over
    one row a source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = W.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(place) - 1, len(weights)) + 1))
    per = per.withColumn("_cap", max_rate * F.col("source_size"))
    per = per.withColumn("_at", F.col("_cap") / F.col("_w"))
    rising, every = W.orderBy("_at", F.col("source").asc_nulls_last()), W.partitionBy(F.lit(1))
    per = (per.withColumn("_all", F.sum("source_size").over(every)).withColumn("_weights", F.sum("_w").over(every))
           .withColumn("_capped", F.sum("_cap").over(rising) - F.col("_cap"))
           .withColumn("_gone", F.sum("_w").over(rising) - F.col("_w")))
    # level if exactly the sources before this one are capped; right where it first stays under this one's cap
    per = per.withColumn("_level", (F.col("_all") - F.col("_capped")) / (F.col("_weights") - F.col("_gone")))
    per = per.withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_at"), F.struct("_at", "source", "_level"))).over(every)["_level"])
    target = F.least(F.col("_cap").cast("double"), F.col("_w") * F.col("_level"))
    return per.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def join_targets(rows: DataFrame, targets: DataFrame, source_col: str = "source") -> DataFrame:
    """``rows`` with the columns of their source's target as ``_size_of_source`` and ``_target``."""
    t = targets.select(F.col("source").alias("_source"), F.col("source_size").alias("_size_of_source"), F.col("target").alias("_target"))
    size = t.agg(F.sum(F.coalesce(F.octet_length("_source"), F.lit(0)) + 48)).first()[0] or 0
    return rows.join(F.broadcast(t) if size <= BROADCAST_BYTES else t, F.col(source_col).eqNullSafe(F.col("_source"))).drop("_source")


def copies(seed: str, id_col: str) -> Column:
    rate = F.coalesce(F.col("_target") / F.nullif(F.col("_size_of_source"), F.lit(0)), F.lit(0.0))
    return (F.floor(rate) + (draw(id_col, seed) < rate - F.floor(rate)).cast("long")).cast("long")


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE, seed: str = "mix") -> DataFrame:
    """Per document: id, size, source_size, target, copies, taken (size times copies)."""
    sizes = written(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size_of(text_col).alias("size")), "sizes")
    targets = written(source_targets(sizes, weights, max_rate), "targets")
    out = join_targets(sizes, targets).withColumn("copies", copies(seed, "id"))
    return out.select(F.col("id").alias(id_col), "size", F.col("_size_of_source").alias("source_size"), F.col("_target").alias("target"),
                      "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE, seed: str = "mix") -> DataFrame:
    """The mixed documents: every row as often as it is emitted, columns unchanged."""
    sizes = docs.select(F.col(source_col).cast("string").alias("source"), size_of(text_col).alias("size"))
    targets = written(source_targets(sizes, weights, max_rate), "targets")
    plain = positional(docs)
    out = join_targets(plain, targets, place(docs, source_col))
    out = out.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies(seed, place(docs, id_col)).cast("int"))))
    return out.select(*plain.columns).toDF(*docs.columns)

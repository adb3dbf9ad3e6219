"""Exact percentiles with bounded state (A10 at scale).

``percentile`` keeps a value -> count map per group, which grows with the
number of distinct values. ``exact_quantiles`` reads the rows once, into one
row per (group, distinct value) with its count (a partial aggregate: a value
repeated a billion times is one row a task), and finds the values at the
ranks wanted (linear interpolation between two neighbours) by running sums
over ranges of values:

1. ranges of equal width in the logarithm of the value: their counts are a
   small table, whose running sums name the range each rank falls in;
2. the same over ``FINE`` equal parts of each range found;
3. a running sum over the distinct values of each part found.

No array of values is ever built, and no task holds more than a part's
values unless they are that close together.

For logs that cannot be read again, ``summaries`` keeps one row a day (or any
other key): count, sum, extremes and a quantile sketch. Summaries of any rows
merge into the summary of all of them, so a year's percentiles come from 365 rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import cut_lineage

RANGES = 64  # ranges per doubling of a value
FINE = 4096


def _range(v: Column) -> Column:
    """Range number of a value; never falls as the value rises."""
    size = F.floor(F.log2(F.lit(1.0) + F.abs(v) * float(1 << 20)) * RANGES)
    return F.when(v < 0, -size).otherwise(size).cast("long")


def _within(targets: DataFrame, counts: DataFrame, keys: list[str], by: str) -> DataFrame:
    """``targets`` (keys, _k, _rank, _below) with the ``by`` whose running count holds the
    rank, and ``_below`` moved up to it. ``counts``: (keys, by, _c, ...), one row per ``by``."""
    run = Window.partitionBy(*keys).orderBy(by)
    c = counts.withColumn("_up", F.sum("_c").over(run))
    j = targets.join(c, keys)
    at = F.col("_rank") - F.col("_below")
    j = j.filter((at < F.col("_up")) & (at >= F.col("_up") - F.col("_c")))
    return j.withColumn("_below", F.col("_below") + F.col("_up") - F.col("_c")).drop("_up", "_c")


def quantiles_of_counts(counts: DataFrame, value: str, count: str, ps: Sequence[float], group_cols: Sequence[str],
                        names: Sequence[str]) -> DataFrame:
    """(group..., q...) from a table with one row per (group, value): its count. The table
    is read several times, so give a written one."""
    g = [F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)] or [F.lit(0).alias("_g0")]
    gn = [f"_g{i}" for i in range(len(g))]
    v = F.col(value).cast("double")
    d = counts.filter(v.isNotNull()).select(*g, v.alias("_v"), F.col(count).alias("_c"), _range(v).alias("_r"))
    # null group keys must meet in joins: compare them by their JSON text
    key = F.to_json(F.struct(*gn))
    d = d.withColumn("_key", key)
    wide = d.groupBy("_key", "_r").agg(F.sum("_c").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    sizes = wide.groupBy("_key").agg(F.sum("_c").alias("_n"))
    ranks = F.array(*[F.struct(F.lit(2 * i + up).alias("k"), (f((F.col("_n") - 1) * F.lit(float(p)))).cast("long").alias("r"))
                      for i, p in enumerate(ps) for up, f in ((0, F.floor), (1, F.ceil))])
    targets = sizes.select("_key", F.explode(ranks).alias("_t")).select("_key", F.col("_t.k").alias("_k"), F.col("_t.r").alias("_rank"),
                                                                       F.lit(0).cast("long").alias("_below"))
    targets = _within(targets, wide, ["_key"], "_r")
    found = targets.select("_key", "_r", "_lo", "_hi").distinct()
    part = F.floor(F.coalesce(F.try_divide(F.col("_v") - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0)) * (FINE - 1)).cast("long")
    near = d.select("_key", "_r", "_v", "_c").join(found, ["_key", "_r"]).withColumn("_f", part).drop("_lo", "_hi")
    fine = near.groupBy("_key", "_r", "_f").agg(F.sum("_c").alias("_c"))
    targets = _within(targets.drop("_lo", "_hi"), fine, ["_key", "_r"], "_f")
    near = near.join(targets.select("_key", "_r", "_f").distinct(), ["_key", "_r", "_f"])
    hits = _within(targets, near, ["_key", "_r", "_f"], "_v")

    def at(k: int) -> Column:
        return F.max(F.when(F.col("_k") == k, F.col("_v")))

    out = []
    for i, (p, name) in enumerate(zip(ps, names, strict=True)):
        pos = (F.first("_n") - 1) * F.lit(float(p))
        share = pos - F.floor(pos)
        out.append(F.when(share == 0, at(2 * i)).otherwise((1 - share) * at(2 * i) + share * at(2 * i + 1)).alias(name))
    q = hits.join(sizes, "_key").groupBy("_key").agg(*out)
    groups = d.select("_key", *gn).distinct() if group_cols else None
    if groups is None:
        return q.drop("_key")
    return groups.join(q, "_key").select(*[F.col(n).alias(c) for n, c in zip(gn, group_cols, strict=True)], *names)


def value_counts(df: DataFrame, value: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """(group..., value, _count): one row per distinct value, written to the shared folder."""
    rows = df.filter(F.col(value).isNotNull()).groupBy(*group_cols, F.col(value).cast("double").alias(value))
    return cut_lineage(rows.agg(F.count(F.lit(1)).alias("_count")), "value-counts")


def exact_quantiles(df: DataFrame, value: str, ps: Sequence[float], group_cols: Sequence[str] = (),
                    names: Sequence[str] | None = None) -> DataFrame:
    """(group..., q...) — exact interpolated percentiles of ``value`` (nulls ignored); the
    rows are read once."""
    names = list(names or [f"p{int(round(p * 100))}" for p in ps])
    return quantiles_of_counts(value_counts(df, value, group_cols), value, "_count", ps, group_cols, names)


# ---- mergeable summaries -------------------------------------------------------------

#: Size of a sketch: some kilobytes. With 800, a quantile's rank is off by less than
#: ``SKETCH_ERROR`` of the rows in 99 of 100 sketches (2.296 / k^0.9021, the bound that the
#: sketch's authors give for one quantile), whatever was merged.
SKETCH_K = 800
SKETCH_ERROR = 2.296 / SKETCH_K ** 0.9021


def summaries(log: DataFrame, seconds: str, error: str, keys: Sequence[str]) -> DataFrame:
    """(keys..., n_ok, errors, total, least, most, sketch): one small row per key, by one
    aggregate with partial sketches in the map tasks."""
    ok = F.col(error).isNull() & F.col(seconds).isNotNull()
    v = F.when(ok, F.col(seconds).cast("double"))
    return log.groupBy(*keys).agg(F.count(v).alias("n_ok"), F.count_if(F.col(error).isNotNull()).alias("errors"), F.sum(v).alias("total"),
                                  F.min(v).alias("least"), F.max(v).alias("most"), F.kll_sketch_agg_double(v, SKETCH_K).alias("sketch"))


def merged(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Summaries of coarser keys from those of finer ones; those of nothing for no rows."""
    return parts.groupBy(*keys).agg(F.coalesce(F.sum("n_ok"), F.lit(0)).alias("n_ok"), F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"), F.sum("total").alias("total"),
                                    F.min("least").alias("least"), F.max("most").alias("most"), F.kll_merge_agg_double("sketch", SKETCH_K).alias("sketch"))


def sketch_quantiles(summary: DataFrame, ps: Sequence[float], names: Sequence[str]) -> DataFrame:
    """``summary`` with mean, min, max and the quantiles ``names`` instead of its sketch; null
    where there was no success."""
    keep = [c for c in summary.columns if c not in ("total", "least", "most", "sketch")]
    q = [F.when(F.col("n_ok") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias(n) for p, n in zip(ps, names, strict=True)]
    return summary.select(*keep, F.try_divide("total", "n_ok").alias("mean"), F.col("least").alias("min"), F.col("most").alias("max"), *q)


def rank_errors(values: DataFrame, value: str, found: dict[float, float]) -> DataFrame:
    """(p, value, rank_error): how far each quantile ``found`` (p -> value) is from rank p among
    all ``values``; 0 if rows equal to it span that rank. One aggregate over the rows."""
    v = F.col(value).cast("double")
    rows = [F.struct(F.lit(float(p)).alias("p"), F.lit(float(q)).alias("value"), F.avg((v < q).cast("double")).alias("lo"), F.avg((v <= q).cast("double")).alias("hi"))
            for p, q in found.items()]
    spans = values.filter(v.isNotNull()).agg(F.array(*rows).alias("x")).select(F.inline("x"))
    return spans.select("p", "value", F.greatest(F.col("lo") - F.col("p"), F.col("p") - F.col("hi"), F.lit(0.0)).alias("rank_error"))

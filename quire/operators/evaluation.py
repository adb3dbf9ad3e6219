"""Classifier evaluation.

Every metric comes from ONE pass over the predictions: a global aggregate of
``count_if`` counters (per label: true positives, predictions, support; per
label pair: confusion cells; plus the hallucination count). A global
aggregate has no grouping key, so no class — however hot — lands in one
task: each task folds its rows into one small row and only those rows are
merged. The per-label table is then unfolded from that single row with
``inline`` (no join, no second scan). The confusion matrix is a count per
pair of labels instead: its cells grow with the square of the label list.

Semantics follow the usual weighted multi-class metrics with a fixed label
list and ``zero_division = 0``:

* predictions outside ``labels`` are *hallucinations*: reported, then
  excluded from every metric (numerator and denominator);
* precision_L = tp_L / #pred==L, recall_L = tp_L / #true==L, over the valid
  rows (rows whose true label is outside ``labels`` still count as
  predictions of L);
* weighted averages weight by support (#true==L); macro averages run over
  every label, zero-support ones included;
* the confusion matrix only counts rows whose truth and prediction are
  both in ``labels``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HALLUCINATION = "hallucination"
DIGITS = 10  # metric rounding, so sums in a different order compare equal


def _r(c: Column) -> Column:
    return F.round(c, DIGITS)


def _labels_col(labels: Sequence[str]) -> Column:
    return F.array(*[F.lit(x) for x in labels])


def normalise_labels(pairs: DataFrame, labels: Sequence[str], cols: Sequence[str] = ("y_true", "y_pred")):
    """Compare labels the way model output is cleaned (spaces and quotes removed):
    returns (pairs with cleaned ``cols``, cleaned label list). Without it a
    cleaned prediction such as 'filefolder' never matches 'file folder' and
    counts as a hallucination."""
    from quire.functions.text import clean_label

    clean = [x.replace(" ", "").replace('"', "") for x in labels]
    out = pairs
    for c in cols:
        out = out.withColumn(c, clean_label(c))
    return out, clean


def mark_hallucinations(pairs: DataFrame, labels: Sequence[str],
                        pred: str = "y_pred", out: str = "y_mapped") -> DataFrame:
    """A2: prediction outside the label list -> 'hallucination'."""
    return pairs.withColumn(
        out, F.when(F.col(pred).isin(list(labels)), F.col(pred)).otherwise(F.lit(HALLUCINATION)))


def _is_valid(labels: Sequence[str], pred: str = "y_pred") -> Column:
    return F.coalesce(F.col(pred).isin(list(labels)), F.lit(False))


def hallucination_counts(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """A3: original invalid predicted strings with their counts, the most frequent first
    (``rank`` from 1; ties by the string)."""
    from pyspark.sql import Window

    n = (pairs.filter(~_is_valid(labels)).groupBy(F.col("y_pred").alias("hallucination"))
         .agg(F.count(F.lit(1)).alias("count")))
    # one row per distinct string
    return n.withColumn("rank", F.row_number().over(Window.orderBy(F.col("count").desc(), F.col("hallucination").asc_nulls_first()))).orderBy("rank")


def hallucination_truth(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """A4: true labels behind the hallucinated predictions."""
    return (pairs.filter(~_is_valid(labels))
            .groupBy(F.col("y_true").alias("true_label"))
            .agg(F.count(F.lit(1)).alias("count")))


def pair_counts(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(y_true, y_pred, n) over valid rows (for inspection; metrics use ``_stats``)."""
    return (pairs.filter(_is_valid(labels))
            .groupBy("y_true", "y_pred").agg(F.count(F.lit(1)).alias("n")))


def label_table(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per label in list order: (label, label_order)."""
    return pairs.sparkSession.range(1).select(
        F.posexplode(_labels_col(labels)).alias("label_order", "label"))


def _stats(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """The single aggregation pass: one row of counters."""
    v = _is_valid(labels)
    t, p = F.col("y_true"), F.col("y_pred")
    aggs = [F.count_if(~v).alias("n_h")]
    for i, lab in enumerate(labels):
        aggs += [F.count_if(v & (t == lab) & (p == lab)).alias(f"tp_{i}"),
                 F.count_if(p == lab).alias(f"ps_{i}"),
                 F.count_if(v & (t == lab)).alias(f"ts_{i}")]
    return pairs.agg(*aggs)


def per_class(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(label, label_order, tp, pred_sum, support, precision, recall, f1_score, n_h)."""
    rows = F.array(*[F.struct(F.lit(lab).alias("label"), F.lit(i).alias("label_order"),
                              F.col(f"tp_{i}").alias("tp"), F.col(f"ps_{i}").alias("pred_sum"),
                              F.col(f"ts_{i}").alias("support"), F.col("n_h").alias("n_h"))
                     for i, lab in enumerate(labels)])
    t = _stats(pairs, labels).select(F.inline(rows))
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pred_sum")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    t = t.withColumn("precision", p).withColumn("recall", r)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    return t.withColumn("f1_score", f1)


def _weighted_row(pc: DataFrame) -> DataFrame:
    """Single-row aggregate over the per-class table (label-sized input)."""
    return pc.agg(
        F.sum("support").alias("w"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1_score") * F.col("support")).alias("wf"),
        F.sum("tp").alias("n_correct"),
        F.sum("pred_sum").alias("n_valid"),
        F.max("n_h").alias("n_h"),
    )


def weighted_metrics(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """A5 + A6: one row (accuracy, precision, recall, f1_score, n_valid, n_hallucinated, coverage).

    Accuracy is over valid rows only; null when every prediction is invalid.
    Every valid row predicts some label, so n_valid = sum of pred_sum and
    n_correct = sum of tp.
    """
    z = lambda c: _r(F.coalesce(F.try_divide(F.col(c), F.col("w")), F.lit(0.0)))
    return _weighted_row(per_class(pairs, labels)).select(
        _r(F.try_divide(F.col("n_correct").cast("double"), F.col("n_valid"))).alias("accuracy"),
        z("wp").alias("precision"), z("wr").alias("recall"), z("wf").alias("f1_score"),
        F.col("n_valid"), F.col("n_h").alias("n_hallucinated"),
        # accuracy leaves hallucinations out; coverage says how much it leaves out
        _r(F.try_divide(F.col("n_valid").cast("double"), F.col("n_valid") + F.col("n_h"))).alias("coverage"))


def confusion_counts(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(y_true, y_pred, n) of the pairs with both in ``labels``: at most one row per pair
    of labels leaves each task, whatever the number of rows."""
    both = pairs.filter(F.col("y_true").isin(list(labels)) & F.col("y_pred").isin(list(labels)))
    return both.groupBy("y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))


def confusion_long(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Dense (y_true, y_pred, true_order, pred_order, n) over labels x labels, zeros kept."""
    grid = label_table(pairs, labels).select(
        F.col("label").alias("y_true"), F.col("label_order").alias("true_order"),
        F.posexplode(_labels_col(labels)).alias("pred_order", "y_pred"))
    return grid.join(confusion_counts(pairs, labels), ["y_true", "y_pred"], "left").select(
        "y_true", "y_pred", "true_order", "pred_order", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def confusion_wide(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """A7 wide: one row per true label, one column per predicted label."""
    return confusion_long(pairs, labels).groupBy("y_true", "true_order").pivot("y_pred", list(labels)).agg(F.sum("n"))


def class_report(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Per class (precision, recall, f1_score, support) + accuracy, macro avg, weighted avg.

    The accuracy row carries accuracy in the three score columns and the
    total support, as in the usual text report. All rows come from one
    aggregate over the (label-sized) per-class table, so the predictions are
    read once.
    """
    n = len(labels)
    pc = per_class(pairs, labels)
    row = lambda name, order, p, r, f, sup: F.struct(
        name.alias("name"), order.alias("row_order"), p.alias("precision"), r.alias("recall"),
        f.alias("f1_score"), sup.cast("long").alias("support"))
    body = F.collect_list(row(F.col("label"), F.col("label_order"), _r(F.col("precision")),
                              _r(F.col("recall")), _r(F.col("f1_score")), F.col("support")))
    w = F.sum("support")
    wavg = lambda c: _r(F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), w), F.lit(0.0)))
    acc = _r(F.try_divide(F.sum("tp").cast("double"), F.sum("pred_sum")))
    tail = F.array(
        row(F.lit("accuracy"), F.lit(n), acc, acc, acc, w),
        row(F.lit("macro avg"), F.lit(n + 1), _r(F.avg("precision")), _r(F.avg("recall")),
            _r(F.avg("f1_score")), w),
        row(F.lit("weighted avg"), F.lit(n + 2), wavg("precision"), wavg("recall"), wavg("f1_score"), w))
    return pc.agg(F.concat(body, tail).alias("_rows")).select(F.inline("_rows"))


def class_report_body(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """The report without its last three rows and without support."""
    return (class_report(pairs, labels).filter(F.col("row_order") < len(labels))
            .drop("support"))


def latency_stats(df: DataFrame, seconds: str = "seconds", error: str = "error",
                  group_cols: Sequence[str] = (), method: str = "bounded",
                  accuracy: int = 100000) -> DataFrame:
    """A10 + A17: mean, median, min, max, p95, p99 over successes (4 decimals) + errors.

    ``method``:
    * ``"bounded"`` (default) — exact, linear interpolation: the log is read
      once, into one row per (group, failed, seconds) with its count, written
      to the shared folder; every figure comes from that table
      (``quantiles.quantiles_of_counts``), so a live model behind ``df`` is
      called once per row;
    * ``"exact"`` — Spark's ``percentile`` in the same single pass (its
      state is a map of distinct values per group);
    * ``"approx"`` — ``percentile_approx`` sketch, one pass, fixed memory.
    """
    from quire.operators.quantiles import quantiles_of_counts
    from quire.session import cut_lineage

    ok = F.col(error).isNull() & F.col(seconds).isNotNull()
    v = F.when(ok, F.col(seconds).cast("double"))
    cols = list(group_cols) + ["mean", "median", "min", "max", "p95", "p99", "n_ok", "errors"]
    if method in ("exact", "approx"):
        base = [F.round(F.avg(v), 4).alias("mean"), F.round(F.min(v), 4).alias("min"),
                F.round(F.max(v), 4).alias("max"), F.count(v).alias("n_ok"),
                F.count_if(F.col(error).isNotNull()).alias("errors")]
        q = (F.percentile(v, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99))) if method == "exact"
             else F.percentile_approx(v, [0.5, 0.95, 0.99], accuracy))
        qs = [F.round(q[0], 4).alias("median"), F.round(q[1], 4).alias("p95"), F.round(q[2], 4).alias("p99")]
        return df.groupBy(*group_cols).agg(*base, *qs).select(*cols)
    if method != "bounded":
        raise ValueError(f"unknown method {method!r}")
    log = df.groupBy(*group_cols, F.col(error).isNotNull().alias("_failed"), v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    log = cut_lineage(log, "latency-counts")
    c = F.col("_c")
    base = [F.round(F.try_divide(F.sum(F.col("_v") * c), F.sum(F.when(F.col("_v").isNotNull(), c))), 4).alias("mean"),
            F.round(F.min("_v"), 4).alias("min"), F.round(F.max("_v"), 4).alias("max"),
            F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), c)), F.lit(0)).alias("n_ok"),
            F.coalesce(F.sum(F.when(F.col("_failed"), c)), F.lit(0)).alias("errors")]
    names = ["median", "p95", "p99"]
    q = quantiles_of_counts(log, "_v", "_c", [0.5, 0.95, 0.99], group_cols, names)
    stats = log.groupBy(*group_cols).agg(*base)
    if not group_cols:
        # one row even for empty input; the quantiles join as scalar subqueries (null when empty)
        return stats.select("*", *[F.round(q.select(n).scalar(), 4).alias(n) for n in names]).select(*cols)
    same = F.lit(True)
    for i, g in enumerate(group_cols):
        q = q.withColumnRenamed(g, f"_q{i}")
        same = same & F.col(g).eqNullSafe(F.col(f"_q{i}"))
    return stats.join(q, same, "left").select("*", *[F.round(n, 4).alias(f"_{n}") for n in names]).select(
        *group_cols, "mean", F.col("_median").alias("median"), "min", "max", F.col("_p95").alias("p95"), F.col("_p99").alias("p99"), "n_ok", "errors")


def evaluate_run(calls: DataFrame, truth: DataFrame, labels: Sequence[str], id_col: str = "id",
                 truth_col: str = "y_true") -> DataFrame:
    """Metrics and latency of one batch-inference run, in one row.

    ``calls`` is the (id, prediction, error, seconds) log of ``batch_classify``.
    A model may answer differently when called again, so the log is
    materialised once (written to the shared checkpoint folder) and both
    the metrics and the latency statistics read that same run. Failed rows
    count as errors and are left out of the metrics (the reference drops
    them from its pairs).
    """
    from quire.session import cut_lineage

    log = cut_lineage(calls, "inference-run")
    pairs = (log.filter(F.col("prediction").isNotNull())
             .join(truth.select(F.col(id_col), F.col(truth_col).alias("y_true")), id_col)
             .select("y_true", F.col("prediction").alias("y_pred")))
    m = weighted_metrics(pairs, labels)
    lat = latency_stats(log)
    # the latency row joins the metrics row as scalar subqueries (merged into one by Catalyst)
    return m.select(*m.columns, *[lat.select(c).scalar().alias(c) for c in lat.columns])

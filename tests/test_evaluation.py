"""Evaluation with hand-computed values and edge cases."""

import pytest

from quire.operators import evaluation as E

LABELS = ["a", "b", "c"]


def pairs(spark, rows):
    return spark.createDataFrame(rows, "y_true string, y_pred string")


def test_weighted_metrics_hand_computed(spark):
    rows = [("a", "a"), ("a", "a"), ("a", "c"), ("b", "a"), ("b", "b"), ("b", "zzz")]
    # valid rows: (a,a)x2,(a,c),(b,a),(b,b): a tp2 pred3 true3 ; b tp1 pred1 true2 ; c tp0 pred1 true0
    r = E.weighted_metrics(pairs(spark, rows), LABELS).collect()[0]
    pa, ra = 2 / 3, 2 / 3
    pb, rb = 1.0, 0.5
    f1a = 2 * pa * ra / (pa + ra)
    f1b = 2 * pb * rb / (pb + rb)
    assert r.n_valid == 5 and r.n_hallucinated == 1
    assert r.accuracy == pytest.approx(3 / 5)
    assert r.precision == pytest.approx((pa * 3 + pb * 2) / 5)
    assert r.recall == pytest.approx((ra * 3 + rb * 2) / 5)
    assert r.f1_score == pytest.approx((f1a * 3 + f1b * 2) / 5)


def test_accuracy_equals_weighted_recall_when_truth_known(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "c"), ("c", "a"), ("c", "c")]
    r = E.weighted_metrics(pairs(spark, rows), LABELS).collect()[0]
    assert r.accuracy == pytest.approx(r.recall)


def test_all_hallucinated(spark):
    r = E.weighted_metrics(pairs(spark, [("a", "x"), ("b", "y")]), LABELS).collect()[0]
    assert r.accuracy is None
    assert (r.precision, r.recall, r.f1_score, r.n_valid, r.n_hallucinated) == (0.0, 0.0, 0.0, 0, 2)


def test_empty_input(spark):
    r = E.weighted_metrics(pairs(spark, []), LABELS).collect()[0]
    assert r.accuracy is None and r.n_valid == 0 and r.n_hallucinated == 0


def test_confusion_sums_to_rows_with_both_labels_known(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("x", "a"), ("c", "q")]
    long = E.confusion_long(pairs(spark, rows), LABELS).collect()
    assert len(long) == 9
    assert sum(r.n for r in long) == 3
    wide = {r.y_true: r for r in E.confusion_wide(pairs(spark, rows), LABELS).collect()}
    assert (wide["a"].a, wide["a"].b, wide["b"].b, wide["c"].a) == (1, 1, 1, 0)


def test_report_has_zero_support_class_and_summary_rows(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b")]
    rep = {r.name: r for r in E.class_report(pairs(spark, rows), LABELS).collect()}
    assert set(rep) == {"a", "b", "c", "accuracy", "macro avg", "weighted avg"}
    assert rep["c"].support == 0 and rep["c"].precision == 0.0
    assert rep["macro avg"].recall == pytest.approx((0.5 + 1.0 + 0.0) / 3)
    assert rep["accuracy"].support == 3
    body = E.class_report_body(pairs(spark, rows), LABELS)
    assert "support" not in body.columns and body.count() == 3


def test_hallucination_tables(spark):
    rows = [("a", "x"), ("b", "x"), ("a", "y"), ("a", "a")]
    h = {r.hallucination: r["count"] for r in E.hallucination_counts(pairs(spark, rows), LABELS).collect()}
    t = {r.true_label: r["count"] for r in E.hallucination_truth(pairs(spark, rows), LABELS).collect()}
    assert h == {"x": 2, "y": 1} and t == {"a": 2, "b": 1}


def test_latency_stats_match_numpy(spark):
    import numpy as np

    vals = [0.5, 1.25, 2.0, 3.5, 10.0, 0.75, 4.25]
    rows = [(v, None) for v in vals] + [(99.0, "timeout"), (None, "refused")]
    df = spark.createDataFrame(rows, "seconds double, error string")
    r = E.latency_stats(df).collect()[0]
    assert r.mean == round(float(np.mean(vals)), 4)
    assert r.median == round(float(np.median(vals)), 4)
    assert r.p95 == round(float(np.percentile(vals, 95)), 4)
    assert r.p99 == round(float(np.percentile(vals, 99)), 4)
    assert (r.min, r.max, r.n_ok, r.errors) == (0.5, 10.0, 7, 2)
    for method in ("exact", "approx"):
        other = E.latency_stats(df, method=method).collect()[0]
        assert other.min == 0.5 and other.errors == 2
    assert E.latency_stats(df, method="exact").collect()[0].p95 == r.p95


def test_coverage_and_label_normalisation(spark):
    labels = ["file folder", "memo"]
    rows = [("file folder", "filefolder"), ("memo", "memo"), ("memo", '"memo"'), ("memo", "junk")]
    raw = E.weighted_metrics(pairs(spark, rows), labels).collect()[0]
    assert (raw.n_valid, raw.n_hallucinated) == (1, 3) and raw.coverage == pytest.approx(0.25)
    cleaned, clean_labels = E.normalise_labels(pairs(spark, rows), labels)
    r = E.weighted_metrics(cleaned, clean_labels).collect()[0]
    assert (r.n_valid, r.n_hallucinated, r.accuracy) == (3, 1, 1.0)


def test_evaluate_run_drops_failed_and_null_predictions(spark):
    calls = spark.createDataFrame(
        [(1, "a", None, 0.5), (2, None, "no prediction", None), (3, None, "Timeout: slow", None),
         (4, "b", None, 1.5), (5, "zzz", None, 1.0)],
        "id long, prediction string, error string, seconds double")
    truth = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a"), (5, "b")], "id long, y_true string")
    r = E.evaluate_run(calls, truth, LABELS).collect()[0]
    assert (r.n_valid, r.n_hallucinated, r.errors, r.n_ok) == (2, 1, 2, 3)
    assert r.accuracy == pytest.approx(0.5) and r.median == 1.0 and r.max == 1.5


def test_report_and_confusion_on_empty_input(spark):
    empty = pairs(spark, [])
    rep = {r.name: r for r in E.class_report(empty, LABELS).collect()}
    assert rep["accuracy"].precision is None and rep["a"].support == 0 and rep["weighted avg"].recall == 0.0
    assert sum(r.n for r in E.confusion_long(empty, LABELS).collect()) == 0


def test_words_of_no_class_leave_before_the_count(spark):
    from quire.operators import classify as C

    df = spark.createDataFrame([(1, "Dear all, the invoice: dear sir"), (2, "nothing"), (3, ""), (4, None), (5, "slide invoice")], "doc_id long, text string")
    out = C.keyword_classify(df, rules=C.DOCUMENT_RULES)
    assert {r.doc_id: (r.prediction, r.error) for r in out.collect()} == {
        1: ("letter", None), 2: ("unknown", None), 3: ("unknown", None), 4: (None, "empty input"), 5: ("invoice", None)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" in plan and "INSET" in plan


def test_eval_normalised_takes_all_sixteen_classes(spark, tmp_dir):
    from quire.plans import evaluation as EV

    docs = spark.createDataFrame([(i, "x", None if i % 2 else "en") for i in range(17)] + [(17, None, "en"), (None, "x", "en")], "doc_id long, text string, lang string")
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    r = EV.eval_normalised(spark, tmp_dir).first()
    assert (r["accuracy"], r["n_valid"], r["n_hallucinated"]) == (1.0, 16, 1)

"""Classification and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import classify as C
from quire.operators import evaluation as E
from quire.plans.common import SQL_LABELS, SQL_PAIRS, doc_pairs, spread, sql_keyword_predict, sql_str_list
from quire.plans.registry import register
from quire.session import cut_lineage
from quire.sources.tables import Tables

LABELS = C.LANG_LABELS
VALID = f"y_pred IN ({sql_str_list(LABELS)})"
PAIRS_CTE = f"pairs AS (SELECT * FROM ({SQL_PAIRS}) WHERE y_true IS NOT NULL AND y_pred IS NOT NULL)"

# per-class table in SQL, shared by the metric oracles
PER_CLASS_CTE = f"""
{PAIRS_CTE},
pc AS (SELECT y_true, y_pred, count(*) AS n FROM pairs WHERE {VALID} GROUP BY y_true, y_pred),
per AS (
  SELECT lt.label, lt.label_order,
         coalesce(tp.tp, 0) AS tp, coalesce(ps.pred_sum, 0) AS pred_sum, coalesce(ts.support, 0) AS support
  FROM {SQL_LABELS}
  LEFT JOIN (SELECT y_true AS label, n AS tp FROM pc WHERE y_true = y_pred) tp USING (label)
  LEFT JOIN (SELECT y_pred AS label, sum(n) AS pred_sum FROM pc GROUP BY 1) ps USING (label)
  LEFT JOIN (SELECT y_true AS label, sum(n) AS support FROM pc GROUP BY 1) ts USING (label)),
pr AS (
  SELECT *, CASE WHEN pred_sum > 0 THEN tp::DOUBLE / pred_sum ELSE 0.0 END AS precision,
            CASE WHEN support > 0 THEN tp::DOUBLE / support ELSE 0.0 END AS recall
  FROM per),
f AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                 ELSE 0.0 END AS f1_score
  FROM pr)
"""


@register("classify_rules", oracle=f"""
SELECT doc_id, {sql_keyword_predict('text')} AS prediction,
       CASE WHEN text IS NULL THEN 'empty input' END AS error
FROM documents
""")
def classify_rules(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents.select("doc_id", "text")
    return C.keyword_classify(docs)


@register("pred_truth_pairs", oracle=f"WITH {PAIRS_CTE} SELECT doc_id, y_true, y_pred FROM pairs")
def pred_truth_pairs(spark, sf_dir):
    return doc_pairs(spark, sf_dir)


@register("hallucination_flag", oracle=f"""
WITH {PAIRS_CTE}
SELECT doc_id, y_true, y_pred, CASE WHEN {VALID} THEN y_pred ELSE 'hallucination' END AS y_mapped
FROM pairs
""")
def hallucination_flag(spark, sf_dir):
    return E.mark_hallucinations(doc_pairs(spark, sf_dir), LABELS)


@register("hallucination_counts", oracle=f"""
WITH {PAIRS_CTE}
SELECT y_pred AS hallucination, count(*) AS count,
       CAST(row_number() OVER (ORDER BY count(*) DESC, y_pred NULLS FIRST) AS INTEGER) AS rank
FROM pairs WHERE NOT ({VALID}) GROUP BY y_pred
""")
def hallucination_counts(spark, sf_dir):
    return E.hallucination_counts(doc_pairs(spark, sf_dir), LABELS)


@register("hallucination_truth", oracle=f"""
WITH {PAIRS_CTE}
SELECT y_true AS true_label, count(*) AS count FROM pairs WHERE NOT ({VALID}) GROUP BY y_true
""")
def hallucination_truth(spark, sf_dir):
    return E.hallucination_truth(doc_pairs(spark, sf_dir), LABELS)


@register("eval_accuracy", oracle=f"""
WITH {PAIRS_CTE}
SELECT round(avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END), 10) AS accuracy
FROM pairs WHERE {VALID}
""")
def eval_accuracy(spark, sf_dir):
    return E.weighted_metrics(doc_pairs(spark, sf_dir), LABELS).select("accuracy")


@register("eval_weighted", bench=True, oracle=f"""
WITH {PER_CLASS_CTE}
SELECT round(sum(tp)::DOUBLE / nullif(sum(pred_sum), 0), 10) AS accuracy,
       round(coalesce(sum(precision * support) / nullif(sum(support), 0), 0.0), 10) AS precision,
       round(coalesce(sum(recall * support) / nullif(sum(support), 0), 0.0), 10) AS recall,
       round(coalesce(sum(f1_score * support) / nullif(sum(support), 0), 0.0), 10) AS f1_score,
       sum(pred_sum)::BIGINT AS n_valid,
       (SELECT count(*) FROM pairs WHERE NOT ({VALID})) AS n_hallucinated,
       round(sum(pred_sum)::DOUBLE / nullif(sum(pred_sum) + (SELECT count(*) FROM pairs WHERE NOT ({VALID})), 0), 10)
         AS coverage
FROM f
""")
def eval_weighted(spark, sf_dir):
    return E.weighted_metrics(doc_pairs(spark, sf_dir), LABELS)


@register("confusion_long", oracle=f"""
WITH {PAIRS_CTE},
pc AS (SELECT y_true, y_pred, count(*) AS n FROM pairs WHERE {VALID} GROUP BY y_true, y_pred)
SELECT t.label AS y_true, p.label AS y_pred, t.label_order AS true_order, p.label_order AS pred_order,
       coalesce(pc.n, 0) AS n
FROM {SQL_LABELS.replace(' AS lt(', ' AS t(')}, {SQL_LABELS.replace(' AS lt(', ' AS p(')}
LEFT JOIN pc ON pc.y_true = t.label AND pc.y_pred = p.label
""")
def confusion_long(spark, sf_dir):
    return E.confusion_long(doc_pairs(spark, sf_dir), LABELS)


_wide_cols = ", ".join(
    f"sum(CASE WHEN y_pred = '{x}' THEN n ELSE 0 END)::BIGINT AS {x}" for x in LABELS)


@register("confusion_wide", oracle=f"""
WITH {PAIRS_CTE},
pc AS (SELECT y_true, y_pred, count(*) AS n FROM pairs WHERE {VALID} GROUP BY y_true, y_pred)
SELECT t.label AS y_true, t.label_order AS true_order, {_wide_cols}
FROM {SQL_LABELS.replace(' AS lt(', ' AS t(')}
LEFT JOIN pc ON pc.y_true = t.label AND pc.y_pred IN ({sql_str_list(LABELS)})
GROUP BY t.label, t.label_order
""")
def confusion_wide(spark, sf_dir):
    return E.confusion_wide(doc_pairs(spark, sf_dir), LABELS)


_REPORT_SQL = f"""
WITH {PER_CLASS_CTE},
w AS (SELECT sum(support) AS w, sum(precision * support) AS wp, sum(recall * support) AS wr,
             sum(f1_score * support) AS wf, sum(tp) AS n_correct, sum(pred_sum) AS n_valid FROM f),
report AS (
  SELECT label AS name, label_order AS row_order, round(precision, 10) AS precision,
         round(recall, 10) AS recall, round(f1_score, 10) AS f1_score, support::BIGINT AS support FROM f
  UNION ALL
  SELECT 'accuracy', {len(LABELS)}, round(n_correct::DOUBLE / nullif(n_valid, 0), 10),
         round(n_correct::DOUBLE / nullif(n_valid, 0), 10), round(n_correct::DOUBLE / nullif(n_valid, 0), 10),
         w::BIGINT FROM w
  UNION ALL
  SELECT 'macro avg', {len(LABELS) + 1}, round(avg(precision), 10), round(avg(recall), 10),
         round(avg(f1_score), 10), sum(support)::BIGINT FROM f
  UNION ALL
  SELECT 'weighted avg', {len(LABELS) + 2}, round(coalesce(wp / nullif(w, 0), 0.0), 10),
         round(coalesce(wr / nullif(w, 0), 0.0), 10), round(coalesce(wf / nullif(w, 0), 0.0), 10),
         w::BIGINT FROM w)
"""


@register("class_report", oracle=_REPORT_SQL + "SELECT * FROM report")
def class_report(spark, sf_dir):
    return E.class_report(doc_pairs(spark, sf_dir), LABELS)


@register("class_report_body", oracle=_REPORT_SQL + f"""
SELECT name, row_order, precision, recall, f1_score FROM report WHERE row_order < {len(LABELS)}
""")
def class_report_body(spark, sf_dir):
    return E.class_report_body(doc_pairs(spark, sf_dir), LABELS)


def _call_log(spark, sf_dir):
    """events as a model-call log: value = seconds, event_type 'error' = failed call."""
    ev = Tables(spark, sf_dir).events
    return ev.select("event_id", "user_id", F.col("value").alias("seconds"),
                     F.when(F.col("event_type") == "error", F.lit("error")).alias("error"),
                     F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200))
                     .alias("status"))


@register("latency_stats", oracle="""
SELECT round(avg(value) FILTER (WHERE event_type IS DISTINCT FROM 'error'), 4) AS mean,
       round(quantile_cont(value, 0.5) FILTER (WHERE event_type IS DISTINCT FROM 'error'), 4) AS median,
       round(min(value) FILTER (WHERE event_type IS DISTINCT FROM 'error'), 4) AS min,
       round(max(value) FILTER (WHERE event_type IS DISTINCT FROM 'error'), 4) AS max,
       round(quantile_cont(value, 0.95) FILTER (WHERE event_type IS DISTINCT FROM 'error'), 4) AS p95,
       round(quantile_cont(value, 0.99) FILTER (WHERE event_type IS DISTINCT FROM 'error'), 4) AS p99,
       count(value) FILTER (WHERE event_type IS DISTINCT FROM 'error') AS n_ok,
       count(*) FILTER (WHERE event_type = 'error') AS errors
FROM events
""")
def latency_stats(spark, sf_dir):
    return E.latency_stats(_call_log(spark, sf_dir))


@register("latency_by_user", oracle="""
SELECT user_id,
       round(avg(value) FILTER (WHERE event_type IS DISTINCT FROM 'error'), 4) AS mean,
       round(quantile_cont(value, 0.5) FILTER (WHERE event_type IS DISTINCT FROM 'error'), 4) AS median,
       round(min(value) FILTER (WHERE event_type IS DISTINCT FROM 'error'), 4) AS min,
       round(max(value) FILTER (WHERE event_type IS DISTINCT FROM 'error'), 4) AS max,
       round(quantile_cont(value, 0.95) FILTER (WHERE event_type IS DISTINCT FROM 'error'), 4) AS p95,
       round(quantile_cont(value, 0.99) FILTER (WHERE event_type IS DISTINCT FROM 'error'), 4) AS p99,
       count(value) FILTER (WHERE event_type IS DISTINCT FROM 'error') AS n_ok,
       count(*) FILTER (WHERE event_type = 'error') AS errors
FROM events GROUP BY user_id
""")
def latency_by_user(spark, sf_dir):
    return E.latency_stats(_call_log(spark, sf_dir), group_cols=["user_id"])


@register("latency_sketch", oracle="""
SELECT p, CASE p WHEN 0.5 THEN round(quantile_cont(value, 0.5), 4) WHEN 0.95 THEN round(quantile_cont(value, 0.95), 4)
                 ELSE round(quantile_cont(value, 0.99), 4) END AS exact, true AS within_bound, count(value) AS n_ok,
       (SELECT count(DISTINCT CAST(ts AS DATE)) FROM events) AS n_days
FROM events, (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) AS q(p) WHERE event_type IS DISTINCT FROM 'error' GROUP BY p
""")
def latency_sketch(spark, sf_dir):
    """A10 from stored daily summaries, merged: the exact percentile, and whether the merged
    sketch's is within the stated rank error of it."""
    from quire.operators import quantiles as Q

    ps, names = [0.5, 0.95, 0.99], ["median", "p95", "p99"]
    log = _call_log(spark, sf_dir)
    days = Tables(spark, sf_dir).events.select("event_id", F.to_date("ts").alias("day"))
    daily = cut_lineage(Q.summaries(log.join(days, "event_id"), "seconds", "error", ["day"]), "daily-latency")
    all_days = Q.sketch_quantiles(Q.merged(daily), ps, names).first()
    errors = Q.rank_errors(log.filter(F.col("error").isNull()), "seconds", {p: all_days[n] for p, n in zip(ps, names) if all_days[n] is not None})
    exact = E.latency_stats(log).select(F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.col(n).alias("exact")) for p, n in zip(ps, names)])).alias("x")).select("x.*")
    return errors.join(exact, "p").select("p", "exact", (F.col("rank_error") <= Q.SKETCH_ERROR).alias("within_bound"), F.lit(all_days["n_ok"]).cast("long").alias("n_ok"),
                                          F.lit(daily.count()).cast("long").alias("n_days"))


@register("status_split", oracle="""
SELECT event_id, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
       event_type IS DISTINCT FROM 'error' AS accepted
FROM events
""")
def status_split(spark, sf_dir):
    calls = _call_log(spark, sf_dir)
    good, bad = C.status_split(calls)
    return (good.select("event_id", "status", F.lit(True).alias("accepted"))
            .unionByName(bad.select("event_id", "status", F.lit(False).alias("accepted"))))


@register("eval_sampled", oracle=f"""
WITH s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents)
           WHERE rn <= 10 AND lang IS NOT NULL AND text IS NOT NULL),
pairs AS (SELECT doc_id, lang AS y_true, {sql_keyword_predict('text')} AS y_pred FROM s),
pc AS (SELECT * FROM pairs WHERE {VALID})
SELECT round(avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END), 10) AS accuracy,
       count(*) AS n_valid, (SELECT count(*) FROM pairs WHERE NOT ({VALID})) AS n_hallucinated
FROM pc
""")
def eval_sampled(spark, sf_dir):
    """The evaluation flow of the reference: 10 documents per class (first by id),
    classified, then scored (the sample is the feature: a K2 head-per-label)."""
    from quire.operators.sampling import first_k_per_group

    docs = (Tables(spark, sf_dir).documents.select("doc_id", "text", "lang")
            .filter(F.col("lang").isNotNull() & F.col("text").isNotNull()))
    sample = first_k_per_group(docs, "lang", ["doc_id"], 10).drop("rn")
    pred = C.keyword_classify(sample, keep=["lang"])
    pairs = pred.select("doc_id", F.col("lang").alias("y_true"), F.col("prediction").alias("y_pred"))
    return E.weighted_metrics(pairs, LABELS).select("accuracy", "n_valid", "n_hallucinated")


def _keyword_model(rows):
    """A stand-in model: the keyword rules over a batch of texts, with the library's own
    token rule (runs of letters and digits, lower-cased)."""
    import regex

    out = []
    for text in rows["text"]:
        if text is None:
            out.append(None)
            continue
        toks = regex.findall(r"[\p{L}\p{N}]+", text.lower())
        hits = {lab: sum(t in words for t in toks) for lab, words in C.LANG_RULES.items()}
        best = max(hits, key=hits.get)
        out.append(best if hits[best] else C.UNKNOWN)
    return out


def _model_log(spark, sf_dir):
    """One run of the pluggable model over all documents, written once: a model may answer
    differently when asked again."""
    docs = spread(Tables(spark, sf_dir).documents.select("doc_id", "text"))
    return cut_lineage(C.batch_classify(docs, None, "doc_id", ["text"], batch_fn=_keyword_model), "model-run")


@register("classify_batch_latency", oracle="""
SELECT count(text) AS n_ok, count(*) - count(text) AS errors, true AS ordered FROM documents
""")
def classify_batch_latency(spark, sf_dir):
    """E1 + E16 + A10 through the pluggable model path: every document is classified once;
    latencies vary per run, so the result says whether they are there and in order."""
    stats = E.latency_stats(_model_log(spark, sf_dir))
    rising = (F.col("min") <= F.col("median")) & (F.col("median") <= F.col("p95")) & (F.col("p95") <= F.col("p99")) & (F.col("p99") <= F.col("max"))
    return stats.select("n_ok", "errors", F.coalesce(rising, F.lit(False)).alias("ordered"))


@register("classify_eval_run", oracle=f"""
WITH {PER_CLASS_CTE}
SELECT round(sum(tp)::DOUBLE / nullif(sum(pred_sum), 0), 10) AS accuracy,
       round(coalesce(sum(precision * support) / nullif(sum(support), 0), 0.0), 10) AS precision,
       round(coalesce(sum(recall * support) / nullif(sum(support), 0), 0.0), 10) AS recall,
       round(coalesce(sum(f1_score * support) / nullif(sum(support), 0), 0.0), 10) AS f1_score,
       sum(pred_sum)::BIGINT AS n_valid,
       (SELECT count(*) FROM documents WHERE text IS NOT NULL) AS n_ok
FROM f
""")
def classify_eval_run(spark, sf_dir):
    """A whole evaluation run: every document through the pluggable model, then metrics and
    the number of answers from the same written call log."""
    truth = Tables(spark, sf_dir).documents.filter("lang IS NOT NULL").select(F.col("doc_id").alias("id"), F.col("lang").alias("y_true"))
    run = E.evaluate_run(_model_log(spark, sf_dir), truth, LABELS)
    return run.select("accuracy", "precision", "recall", "f1_score", "n_valid", "n_ok")


@register("status_calls", oracle="""
SELECT event_id, CASE WHEN event_type = 'error' THEN 500 WHEN value IS NULL THEN 0 ELSE 200 END AS status,
       CASE WHEN event_type = 'error' THEN NULL WHEN value IS NULL THEN NULL ELSE event_id % 97 END AS prompt_tokens
FROM events
""")
def status_calls(spark, sf_dir):
    """A status-coded service called once per event, its usage read from the reply."""
    from quire.operators import tokens as TK

    def call(request):
        if request["event_type"] == "error":
            return 500, "overloaded", None
        if request["value"] != request["value"]:  # no value: the client itself fails
            raise ValueError("nothing to send")
        return 200, "done", '{"usage": {"prompt_tokens": %d}}' % (request["n"] % 97)

    ev = Tables(spark, sf_dir).events.select("event_id", "event_type", "value", F.col("event_id").alias("n"))
    calls = C.run_calls(ev, call, "event_id", ["event_type", "value", "n"])
    return calls.select(F.col("id").alias("event_id"), "status", TK.usage_fields("usage")[2])


# ---- the sixteen classes ---------------------------------------------------------

HEADERS = [f"{words[0]} {words[1]} {words[0]}" for words in C.DOCUMENT_RULES.values()] + ["plain page"]
_SQL_HEADERS = "[" + ", ".join(f"'{h}'" for h in HEADERS) + "]"
_SQL_PAGE = f"({_SQL_HEADERS}[doc_id % {len(HEADERS)} + 1] || chr(10) || text)"


def _headed(spark, sf_dir):
    """Documents under a heading of one of the sixteen classes, or of none, by their id."""
    d = Tables(spark, sf_dir).documents.select("doc_id", "text")
    head = F.element_at(F.array(*map(F.lit, HEADERS)), (F.col("doc_id") % len(HEADERS) + 1).cast("int"))
    return d.select("doc_id", F.concat(head, F.lit("\n"), "text").alias("text"))


@register("classify_documents16", oracle=f"""
SELECT doc_id, {sql_keyword_predict(_SQL_PAGE, C.DOCUMENT_RULES)} AS prediction,
       CASE WHEN text IS NULL THEN 'empty input' END AS error FROM documents
""")
def classify_documents16(spark, sf_dir):
    return C.keyword_classify(_headed(spark, sf_dir), rules=C.DOCUMENT_RULES)


_CLEAN16 = sql_str_list([x.replace(" ", "") for x in C.DOCUMENT_LABELS])
_SQL_TRUTH = "[" + ", ".join(f"'{x}'" for x in [*C.DOCUMENT_LABELS, "plain page"]) + "]"


@register("eval_normalised", oracle=f"""
WITH p AS (SELECT translate({_SQL_TRUTH}[doc_id % {len(HEADERS)} + 1], ' "', '') AS y_true,
                  translate('"' || {sql_keyword_predict(_SQL_PAGE, C.DOCUMENT_RULES)} || '"', ' "', '') AS y_pred
           FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL)
SELECT round(avg(CASE WHEN y_pred = y_true THEN 1.0 ELSE 0.0 END) FILTER (y_pred IN ({_CLEAN16})), 10) AS accuracy,
       count(*) FILTER (y_pred IN ({_CLEAN16})) AS n_valid, count(*) FILTER (y_pred NOT IN ({_CLEAN16})) AS n_hallucinated
FROM p
""")
def eval_normalised(spark, sf_dir):
    """Truth and prediction are compared without spaces and quotes, as a model's answer is
    cleaned: sixteen classes, some of two words, predictions in quotes. Documents under no
    class's heading take part, with a truth that is none of the classes."""
    d = _headed(spark, sf_dir).filter("text IS NOT NULL AND doc_id IS NOT NULL")
    pred = C.keyword_classify(spread(d), rules=C.DOCUMENT_RULES)
    truth = F.element_at(F.array(*map(F.lit, [*C.DOCUMENT_LABELS, "plain page"])), (F.col("doc_id") % len(HEADERS) + 1).cast("int"))
    pairs = pred.select(truth.alias("y_true"), F.concat(F.lit('"'), "prediction", F.lit('"')).alias("y_pred"))
    pairs, clean = E.normalise_labels(pairs, C.DOCUMENT_LABELS)
    return E.weighted_metrics(pairs, clean).select("accuracy", "n_valid", "n_hallucinated")


@register("classify_image", oracle="""
SELECT doc_id, CASE WHEN contains(text, '|') THEN 'form' ELSE 'letter' END AS prediction,
       CASE WHEN text IS NULL THEN 'no prediction' END AS error
FROM documents
""")
def classify_image(spark, sf_dir):
    """The document's bytes as a data URI go to an image model (here one that looks for
    the bars of a table in them)."""
    import base64

    from quire.functions.text import data_uri

    def model(rows):
        bodies = [None if u is None else base64.b64decode(u.split(",", 1)[1]) for u in rows["uri"]]
        return [None if b is None else "form" if b"|" in b else "letter" for b in bodies]

    d = Tables(spark, sf_dir).documents
    req = spread(d.select("doc_id", data_uri(F.encode("text", "UTF-8")).alias("uri")))
    out = C.batch_classify(req, None, "doc_id", ["uri"], batch_fn=model)
    return out.select(F.col("id").alias("doc_id"), "prediction", "error")

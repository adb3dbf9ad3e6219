"""Batch classification.

Two model paths:

* ``keyword_classify`` — the deterministic offline default. A rule table of
  class -> keywords becomes one ``aggregate`` over the tokens that counts
  every class's hits in a single traversal: a narrow projection, no
  shuffle, no Python, whole texts.
* ``batch_classify`` — the pluggable path for a real model: a function of a
  whole Arrow batch (or of one request) runs inside ``mapInPandas``; per-row
  failures become an ``error`` column instead of failing the task, and each
  row carries its latency.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import tokens

# Function-word rules per language class, in label order.
# The driver documents carry their class in ``lang``; ties go to the
# earlier class in this order; no hit at all -> the model answers "unknown".
LANG_RULES: dict[str, tuple[str, ...]] = {
    "en": ("the", "of", "and", "to", "is", "that", "it", "for", "was", "with"),
    "de": ("der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "nicht"),
    "fr": ("le", "les", "et", "des", "du", "une", "pour", "qui", "dans", "avec"),
    "es": ("el", "y", "los", "las", "del", "por", "con", "una", "para", "se"),
}
LANG_LABELS = list(LANG_RULES)

# The sixteen document classes, in their order, with words that
# mark a document of the class (the words are this library's own choice).
DOCUMENT_RULES: dict[str, tuple[str, ...]] = {
    "letter": ("dear", "sincerely", "regards", "yours"),
    "form": ("checkbox", "applicant", "fill", "signature"),
    "email": ("subject", "cc", "forwarded", "reply"),
    "handwritten": ("scribbled", "cursive", "handwriting", "notebook"),
    "advertisement": ("sale", "offer", "discount", "brand"),
    "scientific report": ("experiment", "findings", "laboratory", "measurements"),
    "scientific publication": ("abstract", "references", "journal", "doi"),
    "specification": ("tolerance", "requirements", "dimensions", "compliance"),
    "file folder": ("folder", "archive", "tab", "binder"),
    "news article": ("reporter", "headline", "newspaper", "yesterday"),
    "budget": ("expenditure", "fiscal", "allocation", "forecast"),
    "invoice": ("invoice", "billed", "remittance", "due"),
    "presentation": ("slide", "agenda", "takeaways", "audience"),
    "questionnaire": ("survey", "respondent", "rating", "scale"),
    "resume": ("experience", "education", "skills", "employment"),
    "memo": ("memorandum", "internal", "staff", "attention"),
}
DOCUMENT_LABELS = list(DOCUMENT_RULES)
UNKNOWN = "unknown"


def _best(scores: dict[str, Column]) -> Column:
    return F.greatest(*[
        F.struct(s.alias("hits"), F.lit(-i).alias("neg_order"), F.lit(label).alias("label"))
        for i, (label, s) in enumerate(scores.items())
    ])


def keyword_predict(text, rules: Mapping[str, Sequence[str]] = LANG_RULES,
                    unknown: str = UNKNOWN) -> Column:
    """Arg-max class by keyword hits; ties by rule order; zero hits -> ``unknown``.

    One expression, one pass: the text is tokenised once, the words of no
    class leave by one hash-set ``IN``, and a single ``aggregate`` over the
    few that stay counts the hits of every class; its finish step picks the
    arg-max, where ``greatest`` over (hits, -order) structs lets the earliest
    class win a tie. Null text -> null prediction (an error row upstream).
    """
    labels = list(rules)
    zero = F.struct(*[F.lit(0).alias(f"h{i}") for i in range(len(labels))])

    def step(acc, t):
        return F.struct(*[(acc[f"h{i}"] + F.when(t.isin(list(rules[lab])), 1).otherwise(0)).alias(f"h{i}")
                          for i, lab in enumerate(labels)])

    def finish(acc):
        best = _best({lab: acc[f"h{i}"] for i, lab in enumerate(labels)})
        return F.when(best["hits"] == 0, F.lit(unknown)).otherwise(best["label"])

    words = sorted({w for ws in rules.values() for w in ws})
    return F.aggregate(F.filter(tokens(text), lambda t: t.isin(words)), zero, step, finish)


def keyword_classify(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                     rules: Mapping[str, Sequence[str]] = LANG_RULES,
                     unknown: str = UNKNOWN, keep: Sequence[str] = ()) -> DataFrame:
    """(id, prediction, error) — one narrow projection, no shuffle, whole texts."""
    keep = list(keep)
    return df.select(F.col(id_col), *[F.col(k) for k in keep],
                    keyword_predict(text_col, rules, unknown).alias("prediction"),
                    F.when(F.col(text_col).isNull(), F.lit("empty input")).alias("error"))


def _attempts(call, max_attempts: int, backoff_seconds: float):
    """(result, error, seconds of the last attempt) of ``call()``, retried with exponential back-off."""
    for attempt in range(max_attempts):
        t0 = time.perf_counter()
        try:
            return call(), None, time.perf_counter() - t0
        except Exception as e:  # the row fails, the task goes on
            error = f"{type(e).__name__}: {e}"
            if attempt + 1 < max_attempts:
                time.sleep(backoff_seconds * (2 ** attempt))
    return None, error, None


def batch_classify(df: DataFrame, model_fn: Callable[[pd.DataFrame], object] | None,
                   id_col: str, input_cols: Sequence[str],
                   concurrency: int | None = None, max_attempts: int = 1,
                   backoff_seconds: float = 1.0,
                   batch_fn: Callable[[pd.DataFrame], Sequence] | None = None) -> DataFrame:
    """(id, prediction, error, seconds): run a model over Arrow batches; every row is kept.

    ``batch_fn`` receives a frame of ``input_cols`` with a whole Arrow batch and
    returns one label a row; a row's latency is its share of the call. If the
    call fails, its rows are tried one by one, so one bad row costs no other.
    ``model_fn`` is for models that take one request at a time: it gets a
    one-row frame and returns a label. ``concurrency`` caps concurrent calls by
    the number of partitions (a model endpoint's rate limit), not by threads.
    ``max_attempts`` > 1 retries a failing call with exponential back-off
    inside the task (the latency kept is that of the successful attempt);
    Spark's own task retry only covers lost executors. Ids keep their type.
    Filter and prune *before* calling this: Catalyst cannot push through
    ``mapInPandas``; write the result before reading it twice.
    """
    src = df.select(F.col(id_col).alias("id"), *[F.col(c) for c in input_cols])
    if concurrency:
        src = src.repartition(concurrency)
    cols = list(input_cols)
    one = model_fn if batch_fn is None else (lambda row: list(batch_fn(row))[0])

    def run(batches):
        for pdf in batches:
            n = len(pdf)
            if n and batch_fn is not None:
                labels, error, secs = _attempts(lambda: list(batch_fn(pdf[cols])), max_attempts, backoff_seconds)
                if error is None and len(labels) == n:
                    yield pd.DataFrame({"id": pdf["id"], "prediction": [None if x is None else str(x) for x in labels],
                                        "error": ["no prediction" if x is None else None for x in labels],
                                        "seconds": [None if x is None else secs / n for x in labels]})
                    continue
            out = []
            for i in range(n):
                row = pdf.iloc[i:i + 1]
                pred, error, secs = _attempts(lambda: one(row[cols] if batch_fn is not None else row), max_attempts, backoff_seconds)
                if error is None and pred is None:
                    error, secs = "no prediction", None
                out.append((None if pred is None else str(pred), error, secs))
            yield pd.DataFrame({"id": pdf["id"], "prediction": [o[0] for o in out], "error": [o[1] for o in out], "seconds": [o[2] for o in out]})

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInPandas(run, f"id {kind}, prediction string, error string, seconds double")


def run_calls(df: DataFrame, call: Callable[[dict], tuple], id_col: str, input_cols: Sequence[str],
              max_attempts: int = 1, backoff_seconds: float = 1.0) -> DataFrame:
    """(id, status, body, usage, seconds) of a status-coded service. ``call`` gets a
    request as a dict and returns (status, body, usage JSON); a call that raises
    is status 0 with the error as its body, so no request is lost."""
    src = df.select(F.col(id_col).alias("id"), *[F.col(c) for c in input_cols])

    def run(batches):
        for pdf in batches:
            out = []
            for row in pdf[list(input_cols)].to_dict("records"):
                got, error, secs = _attempts(lambda: call(row), max_attempts, backoff_seconds)
                status, body, usage = (0, error, None) if error is not None else got
                out.append((int(status), body, usage, secs))
            yield pd.DataFrame({"id": pdf["id"], "status": [o[0] for o in out], "body": [o[1] for o in out],
                                "usage": [o[2] for o in out], "seconds": [o[3] for o in out]})

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInPandas(run, f"id {kind}, status int, body string, usage string, seconds double")


def status_split(calls: DataFrame, status_col: str = "status"):
    """(good, rejects): the caller keeps only HTTP 200; the rest is a reject table."""
    ok = F.coalesce(F.col(status_col) == 200, F.lit(False))
    return calls.filter(ok), calls.filter(~ok)

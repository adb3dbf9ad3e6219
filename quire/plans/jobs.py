"""Model jobs over the documents: calls with an outcome per row, jobs that are run again,
the stored response cache. The models are small deterministic functions that fail where a
real one might."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import calls as CL
from quire.operators import response_cache as RC
from quire.operators.classify import keyword_predict
from quire.plans.common import spread, sql_keyword_predict
from quire.plans.registry import register
from quire.session import cut_lineage, fresh_folder
from quire.sources.tables import Tables

EMBED_DIM = 1536
#: Longest text the stand-in embedding model takes, in characters.
EMBED_LIMIT = 4000


def _docs(spark, sf_dir):
    return Tables(spark, sf_dir).documents.select("doc_id", "text")


@register("embed_outcomes", oracle=f"""
SELECT doc_id, CASE WHEN length(coalesce(text, '')) <= {EMBED_LIMIT} THEN {EMBED_DIM} END AS dim,
       CASE WHEN length(coalesce(text, '')) <= {EMBED_LIMIT} THEN CAST(length(coalesce(text, '')) AS DOUBLE) END AS total,
       CASE WHEN length(coalesce(text, '')) <= {EMBED_LIMIT} THEN CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) END AS spaces,
       CASE WHEN length(coalesce(text, '')) > {EMBED_LIMIT} THEN 'ValueError: text too long' END AS error
FROM documents
""")
def embed_outcomes(spark, sf_dir):
    """A model of 1536 numbers that refuses a whole call if one text is too long; every
    other text of the call has its vector, the long ones have an error."""
    import numpy as np

    def model(texts):
        if any(len(t) > EMBED_LIMIT for t in texts):
            raise ValueError("text too long")
        codes = [np.frombuffer(t.encode("utf-32-le"), "<u4") for t in texts]
        return [np.bincount(c % EMBED_DIM, minlength=EMBED_DIM) for c in codes]

    out = cut_lineage(CL.embed_outcomes(spread(_docs(spark, sf_dir)), "text", model, EMBED_DIM, "doc_id", max_attempts=1), "embedded")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return out.select("doc_id", F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("dim"), total.alias("total"),
                      F.get("embedding", 32).cast("double").alias("spaces"), "error")


@register("resumable_classify", oracle=f"""
SELECT doc_id, {sql_keyword_predict('text')} AS prediction, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS round, CAST(NULL AS VARCHAR) AS error
FROM documents WHERE text IS NOT NULL
""")
def resumable_classify(spark, sf_dir):
    """E1 + E19: a job whose model fails on its first try of every third document. The job is
    stopped after one round and run again; every document ends with one result, and only
    the failed ones were called twice."""
    from quire.operators.classify import LANG_RULES, UNKNOWN

    rules = {k: set(v) for k, v in LANG_RULES.items()}

    def model(frame):
        import regex

        if ((frame["round"] == 1) & (frame["doc_id"] % 3 == 0)).any():
            raise RuntimeError("no answer")
        out = []
        for text in frame["text"]:
            words = regex.split(r"[^\p{L}\p{N}]+", text.lower())
            hits = {k: sum(w in v for w in words) for k, v in rules.items()}
            best = max(hits, key=hits.get)
            out.append(best if hits[best] else UNKNOWN)
        return {"prediction": out}

    path, docs = fresh_folder(spark, "classify-job"), spread(_docs(spark, sf_dir).filter("text IS NOT NULL"))
    for rounds in (1, 2):
        found = CL.run_job(path, docs, "doc_id", ["doc_id", "text"], model, "prediction string", rows_per_commit=2000, max_rounds=rounds)
    return found.select("doc_id", "prediction", "round", "error")


_KEY_SQL = "sha256(coalesce(length(text) || ':' || text, '-') || '2:m1' || '1:1')"


@register("response_cache", oracle=f"""
WITH r AS (SELECT doc_id, text, {_KEY_SQL} AS key FROM documents),
old AS (SELECT DISTINCT key FROM r WHERE doc_id % 2 = 0)
SELECT doc_id, key, 'label:' || ({sql_keyword_predict('text')}) AS response,
       (text IS NOT NULL AND key IN (SELECT key FROM old)) AS hit,
       (SELECT count(DISTINCT key) FROM r WHERE text IS NOT NULL AND key NOT IN (SELECT key FROM old)) AS n_computed
FROM r
""")
def response_cache(spark, sf_dir):
    """Two batches of requests against a stored cache: the documents of even id, then all.
    The second computes only the keys the first did not store."""
    path = fresh_folder(spark, "responses")
    req = _docs(spark, sf_dir).withColumns({"model": F.lit("m1"), "n": F.lit(1)})

    def compute(missing):
        return missing.select("key", F.concat(F.lit("label:"), keyword_predict("text")).alias("response"))

    cols = ["text", "model", "n"]
    RC.answer(path, req.filter("doc_id % 2 = 0"), cols, compute)
    second = RC.answer(path, req, cols, compute)
    return second.rows.select("doc_id", "key", "response", "hit", F.lit(second.computed).cast("long").alias("n_computed"))

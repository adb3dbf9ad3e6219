"""Sampling and split queries over ``documents`` (class = ``lang``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import sampling as S
from quire.plans.registry import register
from quire.session import fresh_folder
from quire.sources.tables import Tables

SEED = "42"
_RANK_SQL = f"""
WITH r AS (
  SELECT doc_id, lang,
         row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || ':{SEED}'), doc_id) - 1 AS r,
         count(*) OVER (PARTITION BY lang) AS n
  FROM documents),
s AS (
  SELECT doc_id, lang,
         CASE WHEN r < floor(n * 0.7) THEN 'train' ELSE 'test' END AS set,
         CAST(CASE WHEN r < floor(n * 0.7) THEN r ELSE r - floor(n * 0.7) END AS BIGINT) AS idx
  FROM r)
"""


def _docs(spark, sf_dir):
    return Tables(spark, sf_dir).documents.select("doc_id", "lang", "source")


def _split(spark, sf_dir):
    return S.train_test_split(_docs(spark, sf_dir).drop("source"), "lang", "doc_id", SEED)


@register("stratified_sample", oracle="""
SELECT doc_id, lang, source, rn FROM (
  SELECT doc_id, lang, source, CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS INTEGER) AS rn FROM documents)
WHERE rn <= 100
""")
def stratified_sample(spark, sf_dir):
    return S.first_k_per_group(_docs(spark, sf_dir), "lang", ["doc_id"], 100)


@register("head_per_label", oracle="""
SELECT doc_id, lang, source, rn FROM (
  SELECT doc_id, lang, source, CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS INTEGER) AS rn FROM documents)
WHERE rn <= 10
""")
def head_per_label(spark, sf_dir):
    return S.first_k_per_group(_docs(spark, sf_dir), "lang", ["doc_id"], 10)


@register("nth_in_class", oracle="""
SELECT doc_id, lang, source FROM (
  SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents)
WHERE rn = 11
""")
def nth_in_class(spark, sf_dir):
    return S.nth_in_group(_docs(spark, sf_dir), "lang", ["doc_id"], 10)


@register("train_test_split", oracle=_RANK_SQL + "SELECT * FROM s")
def train_test_split(spark, sf_dir):
    return _split(spark, sf_dir)


@register("split_filter", oracle=_RANK_SQL + "SELECT * FROM s WHERE set = 'test'")
def split_filter(spark, sf_dir):
    return _split(spark, sf_dir).filter(F.col("set") == "test")


@register("split_names", oracle=_RANK_SQL + """
SELECT doc_id, lang, set, idx, lang || '_' || CAST(idx AS VARCHAR) || '.png' AS name,
       set || '/' || lang || '/' || lang || '_' || CAST(idx AS VARCHAR) || '.png' AS location
FROM s
""")
def split_names(spark, sf_dir):
    return S.split_names(_split(spark, sf_dir), "lang")


@register("label_set_counts", oracle=_RANK_SQL + """
SELECT lang, count(*) FILTER (WHERE set = 'test') AS test, count(*) FILTER (WHERE set = 'train') AS train
FROM s GROUP BY lang
""")
def label_set_counts(spark, sf_dir):
    return S.label_set_counts(_split(spark, sf_dir), "lang")


@register("index_upload_batches", oracle="""
WITH b AS (
  SELECT doc_id, substr(md5(CAST(doc_id AS VARCHAR) || ':batch'), 1, 1) AS bucket,
         md5(CAST(doc_id AS VARCHAR) || ':batch') AS h
  FROM documents)
SELECT doc_id, bucket,
       CAST(floor((row_number() OVER (PARTITION BY bucket ORDER BY h, doc_id) - 1) / 100) AS BIGINT) AS batch_id,
       'succeeded' AS status
FROM b
""")
def index_upload_batches(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents.select("doc_id")
    return S.add_batches(docs, "doc_id").withColumn("status", F.lit("succeeded"))


@register("index_upload_status", oracle="""
WITH k AS (SELECT doc_id, text, octet_length(encode(text)) > 8000 AS big, md5(CAST(doc_id AS VARCHAR) || ':batch') AS h FROM documents),
ok AS (SELECT doc_id, substr(h, 1, 1) AS bucket,
              CAST(floor((row_number() OVER (PARTITION BY substr(h, 1, 1) ORDER BY h, doc_id) - 1) / 100) AS BIGINT) AS batch_id
       FROM k WHERE text IS NOT NULL AND NOT big)
SELECT doc_id, bucket, batch_id, 'succeeded' AS status, NULL::VARCHAR AS reason FROM ok
UNION ALL
SELECT doc_id, NULL, NULL, 'rejected', CASE WHEN text IS NULL THEN 'missing:text' ELSE 'too long:text' END FROM k WHERE text IS NULL OR big
""")
def index_upload_status(spark, sf_dir):
    """S13 + K6: documents uploaded in batches; those of more than 8000 bytes are rejected."""
    docs = Tables(spark, sf_dir).documents.select("doc_id", "text")
    return S.upload_batches(docs, "doc_id", fresh_folder(spark, "upload"), ["text"], max_bytes=8000)

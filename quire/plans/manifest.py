"""Manifest, file pairing, URL and prompt-text queries.

Driver tables stand in for the missing image folder: each document is a
file ``<source>/<doc_id>.png``, a ``labels`` row means its layout result
(``.ocr.json``) exists, and ``pages.url`` is an object listing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions import urls as U
from quire.operators import pairing as J
from quire.operators import sampling as S
from quire.operators.classify import DOCUMENT_LABELS, keyword_predict
from quire.plans.common import sql_keyword_predict, sql_str_list
from quire.plans.registry import register
from quire.plans.sampling import _RANK_SQL, SEED
from quire.sources import files as FS
from quire.session import fresh_folder
from quire.sources.tables import Tables

OBJECT_HOST = "example.net"
WIN_ROOT = "C:\\data\\scanned"
PROMPT_HEAD = ("Sort a scanned page into one of these kinds:\n" + "".join(f"- {c}\n" for c in DOCUMENT_LABELS)
               + "Judge by what the page is for, not by its topic. The page follows.\n\n")
PROMPT_TAIL = "\n\nReply with the kind alone, spelled as in the list."

_SQL_DOC_PATH = "source || '/' || CAST(doc_id AS VARCHAR) || '.png'"
_SQL_PATH = r"regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '[?#].*$', '')"
_SQL_EXT = f"lower(regexp_extract({_SQL_PATH}, '(\\.[A-Za-z0-9]+)$', 1))"
_SIDE_OK = f"({_SQL_EXT} IN ({sql_str_list(U.TRAIN_EXTENSIONS)}) OR url LIKE '%.ocr.json' OR url LIKE '%.jsonl')"


def _docs(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "lang", "source")
    return d.withColumn("path", F.concat_ws("/", "source", F.concat(F.col("doc_id").cast("string"), F.lit(".png"))))


def _done(spark, sf_dir):
    return Tables(spark, sf_dir).labels.select("doc_id")


def _class_col():
    return F.concat_ws("-", "lang", "source")


@register("manifest_scan", oracle=_RANK_SQL + """
SELECT set || '/' || lang || '/' || lang || '_' || CAST(idx AS VARCHAR) || '.png' AS location,
       lang AS label, set FROM s
""")
def manifest_scan(spark, sf_dir):
    """S1 + S2: the split's manifest is written as CSV, a folder per set, and read again."""
    d = Tables(spark, sf_dir).documents.select("doc_id", "lang")
    named = S.split_names(S.train_test_split(d, "lang", "doc_id", SEED), "lang")
    path = fresh_folder(spark, "manifest")
    FS.write_manifest(named.select("location", F.col("lang").alias("label"), "set"), path, partition_by_set=True)
    return FS.read_manifest(spark, path).select("location", "label", "set")


@register("pending_docs", oracle=f"""
SELECT doc_id, {_SQL_DOC_PATH} AS path FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def pending_docs(spark, sf_dir):
    return J.pending(_docs(spark, sf_dir), _done(spark, sf_dir), "doc_id").select("doc_id", "path")


_PAIRED_SQL = f"""
p AS (SELECT doc_id, lang, source, {_SQL_DOC_PATH} AS path FROM documents d
      WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id))
"""


@register("paired_docs", oracle=f"""
WITH {_PAIRED_SQL}
SELECT doc_id, path, 'document' AS kind FROM p
UNION ALL SELECT doc_id, path || '.ocr.json', 'layout' FROM p
""")
def paired_docs(spark, sf_dir):
    p = J.paired(_docs(spark, sf_dir), _done(spark, sf_dir), "doc_id")
    return (p.select("doc_id", "path", F.lit("document").alias("kind"))
            .unionByName(p.select("doc_id", F.concat("path", F.lit(".ocr.json")).alias("path"),
                                  F.lit("layout").alias("kind"))))


@register("incompatible_docs", oracle=f"""
SELECT {_SQL_DOC_PATH} AS path, 'missing_result' AS reason FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
UNION ALL
SELECT url, 'unsupported_extension' FROM pages WHERE NOT {_SIDE_OK}
""")
def incompatible_docs(spark, sf_dir):
    pages = Tables(spark, sf_dir).pages.select("url")
    ok = (U.has_extension(F.col("url"), U.TRAIN_EXTENSIONS) | F.col("url").endswith(".ocr.json")
          | F.col("url").endswith(".jsonl"))
    return J.incompatible(_docs(spark, sf_dir), _done(spark, sf_dir), "doc_id", pages, "url", ok)


@register("class_file_lists", oracle=f"""
WITH {_PAIRED_SQL}
SELECT lang || '-' || source AS class, count(*) AS n_files FROM p GROUP BY 1 HAVING count(*) >= 5
""")
def class_file_lists(spark, sf_dir):
    p = J.paired(_docs(spark, sf_dir), _done(spark, sf_dir), "doc_id").withColumn("class", _class_col())
    return FS.qualifying_classes(p, "class", 5)


@register("class_files", oracle=f"""
WITH {_PAIRED_SQL},
c AS (SELECT lang || '-' || source AS class, path FROM p),
q AS (SELECT class FROM c GROUP BY class HAVING count(*) >= 5)
SELECT class, class || '.jsonl' AS list_file, path AS file FROM c JOIN q USING (class)
""")
def class_files(spark, sf_dir):
    p = J.paired(_docs(spark, sf_dir), _done(spark, sf_dir), "doc_id").withColumn("class", _class_col())
    q = FS.qualifying_classes(p, "class", 5).select("class")
    # the qualifying-class table has one row per class: broadcast after a size check
    return (p.join(q, "class")
            .select("class", F.concat("class", F.lit(".jsonl")).alias("list_file"), F.col("path").alias("file")))


@register("upload_list", oracle=f"""
WITH {_PAIRED_SQL},
q AS (SELECT lang || '-' || source AS class FROM p GROUP BY 1 HAVING count(*) >= 5)
SELECT DISTINCT path FROM (
  SELECT path FROM p UNION ALL SELECT path || '.ocr.json' FROM p UNION ALL SELECT class || '.jsonl' FROM q)
""")
def upload_list(spark, sf_dir):
    p = J.paired(_docs(spark, sf_dir), _done(spark, sf_dir), "doc_id").withColumn("class", _class_col())
    q = FS.qualifying_classes(p, "class", 5)
    return J.upload_list(p, p.select(F.concat("path", F.lit(".ocr.json")).alias("path")),
                         q.select(F.concat("class", F.lit(".jsonl")).alias("path")))


@register("url_container_blob", oracle=f"""
WITH s AS (SELECT page_id, string_split(regexp_replace({_SQL_PATH}, '^/+', ''), '/') AS segs FROM pages)
SELECT page_id, segs[1] AS container, array_to_string(segs[2:], '/') AS blob FROM s
""")
def url_container_blob(spark, sf_dir):
    pages = Tables(spark, sf_dir).pages.select("page_id", "url")
    c, b = U.container_and_blob("url")
    return pages.select("page_id", c.alias("container"), b.alias("blob"))


@register("url_route", oracle=f"""
SELECT page_id, CASE WHEN url LIKE 'http://%' THEN 'error'
  WHEN url LIKE 'https://%' AND regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) LIKE '%{OBJECT_HOST}' THEN 'object'
  WHEN url LIKE 'https://%' THEN 'url' ELSE 'local' END AS route
FROM pages
""")
def url_route(spark, sf_dir):
    pages = Tables(spark, sf_dir).pages.select("page_id", "url")
    return pages.select("page_id", U.route("url", OBJECT_HOST).alias("route"))


@register("valid_extension_filter", oracle=f"""
SELECT page_id, url, {_SQL_EXT} AS ext, {_SQL_EXT} IN ({sql_str_list(U.TRAIN_EXTENSIONS + ('.html',))}) AS valid
FROM pages
""")
def valid_extension_filter(spark, sf_dir):
    pages = Tables(spark, sf_dir).pages.select("page_id", "url")
    allowed = U.TRAIN_EXTENSIONS + (".html",)
    return pages.select("page_id", "url", U.extension("url").alias("ext"),
                        U.has_extension("url", allowed).alias("valid"))


@register("basename_collisions", oracle=f"""
WITH s AS (SELECT url AS path, regexp_extract({_SQL_PATH}, '([^/]*)$', 1) AS name FROM pages
           WHERE starts_with({_SQL_PATH}, '/en/'))
SELECT path, name, 'downloads/' || name AS destination, count(*) OVER (PARTITION BY name) AS collisions FROM s
""")
def basename_collisions(spark, sf_dir):
    pages = Tables(spark, sf_dir).pages.select("url")
    return FS.download_plan(pages, "url", "/en/", "downloads")


@register("object_names", oracle="""
SELECT doc_id, source || '/' || CAST(doc_id AS VARCHAR) || '.png' AS object_name FROM documents
""")
def object_names(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "source")
    local = F.concat(F.lit(WIN_ROOT + "\\"), F.col("source"), F.lit("\\"),
                     F.col("doc_id").cast("string"), F.lit(".png"))
    return d.select("doc_id", U.object_name(local, WIN_ROOT).alias("object_name"))


@register("metadata_format", oracle="""
SELECT 'events/' || CAST(event_id AS VARCHAR) || '.json' AS source, CAST(event_id AS VARCHAR) || '.json' AS name,
       CAST(length(props) AS BIGINT) AS size, 'application/json' AS content_type,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN ''
            ELSE '.' || lpad(CAST(microsecond(ts) % 1000000 AS VARCHAR), 6, '0') END || '+00:00' AS last_modified
FROM events
""")
def metadata_format(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("event_id", "ts", "props")
    name = F.concat(F.col("event_id").cast("string"), F.lit(".json"))
    meta = ev.select(F.concat(F.lit("events/"), name).alias("url"), name.alias("name"),
                     F.length("props").cast("long").alias("size"),
                     U.mime_type(F.lit(".json")).alias("content_type"),
                     F.col("ts").alias("last_modified"))
    return FS.format_metadata(meta)


@register("data_uri", oracle="""
SELECT doc_id, 'data:image/jpeg;base64,' || to_base64(encode(text)) AS uri FROM documents
""")
def data_uri(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "text")
    return d.select("doc_id", X.data_uri(F.encode("text", "UTF-8")).alias("uri"))


@register("clean_label", oracle="""
SELECT doc_id, translate(text, ' "', '') AS label FROM documents
""")
def clean_label(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "text")
    return d.select("doc_id", X.clean_label("text").alias("label"))


@register("snippet", oracle="""
SELECT doc_id, substr(translate(text, chr(10), ' '), 1, 1000) AS snippet FROM documents
""")
def snippet(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "text")
    return d.select("doc_id", X.snippet("text").alias("snippet"))


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


@register("render_prompt", oracle=f"""
SELECT doc_id, {_sql_lit(PROMPT_HEAD)} || coalesce(text, '') || {_sql_lit(PROMPT_TAIL)} AS prompt FROM documents
""")
def render_prompt(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "text")
    return d.select("doc_id", X.render(PROMPT_HEAD, "text", PROMPT_TAIL).alias("prompt"))


@register("prompt_cache", oracle=f"""
WITH req AS (SELECT doc_id, text, sha256(coalesce(length(text) || ':' || text, '-') || '2:m1' || '1:1') AS key FROM documents),
cache AS (SELECT DISTINCT r.key FROM req r JOIN labels l USING (doc_id))
SELECT doc_id, key, 'label:' || ({sql_keyword_predict('text')}) AS response,
       key IN (SELECT key FROM cache) AS hit
FROM req
""")
def prompt_cache(spark, sf_dir):
    t = Tables(spark, sf_dir)
    req = t.documents.select("doc_id", "text", F.lit("m1").alias("model"), F.lit(1).alias("n"))
    cols = ["text", "model", "n"]

    def compute(keys):
        return keys.select("key", F.concat(F.lit("label:"), keyword_predict("text")).alias("response"))

    # initial cache: responses already stored for the labelled documents
    seed_req = req.join(t.labels.select("doc_id"), "doc_id", "left_semi")
    cache0 = compute(seed_req.withColumn("key", J.cache_key(cols)).dropDuplicates(["key"]))
    answers, _ = J.cached_apply(req, cache0, cols, compute)
    hits = cache0.select("key", F.lit(True).alias("hit"))
    return (answers.join(hits, "key", "left")
            .select("doc_id", "key", "response", F.coalesce("hit", F.lit(False)).alias("hit")))


@register("file_lists", oracle="""
SELECT lang AS class, source || '/' || CAST(doc_id AS VARCHAR) || '.png' AS file FROM documents
WHERE lang IN (SELECT lang FROM documents GROUP BY lang HAVING count(*) >= 5)
""")
def file_lists(spark, sf_dir):
    """S4 + S5: ``<class>.jsonl`` lists of the classes with at least five documents, written and
    read again; the class comes from the file's stem."""
    path = fresh_folder(spark, "file-lists")
    FS.write_class_lists(_docs(spark, sf_dir).withColumnRenamed("lang", "class"), "class", "path", path)
    return FS.read_class_lists(spark, path).select("class", "file")


def _landed(spark, sf_dir):
    """Documents as JSON-lines files in a folder per language."""
    path = fresh_folder(spark, "landed")
    d = Tables(spark, sf_dir).documents.filter("lang IS NOT NULL").select("doc_id", "text", "lang")
    d.write.option("maxRecordsPerFile", 100_000).partitionBy("lang").json(path)  # a file is read back as one value
    return path


_LANG_OF_PATH = r"/lang=([^/]+)/[^/]+$"


@register("binary_documents", oracle="""
SELECT lang, count(*) AS n_rows, true AS small FROM documents WHERE lang IS NOT NULL GROUP BY lang
""")
def binary_documents(spark, sf_dir):
    """Landed files read back as bytes by suffix; a row is a line feed."""
    files = FS.read_documents(spark, _landed(spark, sf_dir), allowed=(".JSON",))
    lines = F.length(F.regexp_replace(F.decode("content", "UTF-8"), "[^\n]", "")).cast("long")
    return files.groupBy(F.regexp_extract("path", _LANG_OF_PATH, 1).alias("lang")).agg(
        F.sum(lines).alias("n_rows"), (F.max("length") < 1 << 31).alias("small"))


@register("file_metadata", oracle="""
SELECT lang, 'application/json' AS content_type, true AS has_bytes, true AS has_time FROM documents WHERE lang IS NOT NULL GROUP BY lang
""")
def file_metadata(spark, sf_dir):
    """S7 + S8: name, size, type and ISO time of the landed files, their bodies unread."""
    meta = FS.format_metadata(FS.file_metadata(spark, _landed(spark, sf_dir))).filter(F.col("name").endswith(".json"))
    return meta.groupBy(F.regexp_extract("source", _LANG_OF_PATH, 1).alias("lang"), "content_type").agg(
        (F.sum("size") > 0).alias("has_bytes"), F.bool_and(F.col("last_modified").rlike(r"^\d{4}-\d\d-\d\dT.*\+00:00$|Z$")).alias("has_time"))


@register("format_round_trip", oracle="""
SELECT format, c_custkey, c_name, c_acctbal FROM customer, (VALUES ('csv'), ('json'), ('orc'), ('parquet')) AS f(format)
""")
def format_round_trip(spark, sf_dir):
    """S9 + S10: customers saved in every format and loaded by the path's ending."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_acctbal")
    parts = []
    for fmt in sorted(FS.FORMATS):
        path = f"{fresh_folder(spark, 'formats')}/customer.{fmt}"
        FS.save_table(c, path, fmt)
        parts.append(FS.load_table(spark, path, c.schema).select(F.lit(fmt).alias("format"), "c_custkey", "c_name", "c_acctbal"))
    return reduce(lambda a, b: a.unionByName(b), parts)

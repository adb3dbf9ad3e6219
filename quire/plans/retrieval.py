"""Retrieval queries: ``documents`` is the index content, ``benchmark`` the
search queries, ``embeddings`` a vector collection (queried by its class
centroids)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import keyword_index as KI
from quire.operators import retrieval as R
from quire.operators import vector_index as VI
from quire.plans.common import sql_hashed_embedding, spread, sql_tokens, text_partitions
from quire.plans.registry import register
from quire.session import fresh_folder
from quire.sources.tables import Tables

KW_TOP, VEC_K, HYBRID_TOP, RERANK_TOP, FUSE_DEPTH = 5, 3, 5, 3, 50


def _docs(spark, sf_dir):
    return Tables(spark, sf_dir).documents.select("doc_id", "text")


def _queries(spark, sf_dir):
    return Tables(spark, sf_dir).benchmark.select("item_id", "text")


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


# ---- SQL building blocks --------------------------------------------------------

_BM25_CTE = f"""
dt AS (SELECT doc_id, {sql_tokens('text')} AS toks FROM documents),
stats AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM dt),
qt AS (SELECT DISTINCT item_id, unnest(list_distinct({sql_tokens('text')})) AS term FROM benchmark),
post AS (SELECT doc_id, dl, term, count(*) AS tf
         FROM (SELECT doc_id, len(toks) AS dl, unnest(toks) AS term FROM dt)
         WHERE term IN (SELECT term FROM qt) GROUP BY doc_id, dl, term),
dfq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
bm AS (SELECT item_id, doc_id,
              round(sum(ln(1.0 + (stats.n - df + 0.5) / (df + 0.5))
                        * (tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / stats.avgdl)))), 8) AS score
       FROM post JOIN dfq USING (term) JOIN qt USING (term) CROSS JOIN stats GROUP BY item_id, doc_id)
"""


def _rank_sql(src: str, qid: str, did: str, k: int) -> str:
    return (f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {qid} ORDER BY score DESC, {did}) "
            f"AS INTEGER) AS rank FROM {src}) WHERE rank <= {k}")


def _hash_sql(t: str) -> str:
    return f"(CAST('0x' || substr(md5({t}), 1, 8) AS BIGINT) % {R.HASH_DIM})"


_DOCVEC_CTE = f"""
db AS (SELECT doc_id, b, count(*) AS c FROM (SELECT doc_id, {_hash_sql('t')} AS b
       FROM (SELECT doc_id, unnest({sql_tokens('text')}) AS t FROM documents)) GROUP BY doc_id, b),
dn AS (SELECT doc_id, sqrt(sum(c * c)) AS n FROM db GROUP BY doc_id),
qb AS (SELECT item_id, b, count(*) AS c FROM (SELECT item_id, {_hash_sql('t')} AS b
       FROM (SELECT item_id, unnest({sql_tokens('text')}) AS t FROM benchmark)) GROUP BY item_id, b),
qn AS (SELECT item_id, sqrt(sum(c * c)) AS n FROM qb GROUP BY item_id),
vs AS (SELECT qb.item_id AS qid, db.doc_id AS doc_id,
              round(sum(qb.c * db.c) / (any_value(qn.n) * any_value(dn.n)), 8) AS score
       FROM qb JOIN db USING (b) JOIN qn ON qn.item_id = qb.item_id JOIN dn ON dn.doc_id = db.doc_id
       GROUP BY qb.item_id, db.doc_id),
vtop AS ({_rank_sql('vs', 'qid', 'doc_id', VEC_K)})
"""

_FUSE_CTE = f"""
{_BM25_CTE},
{_DOCVEC_CTE},
ktop AS ({_rank_sql('bm', 'item_id', 'doc_id', FUSE_DEPTH)}),
fused AS (SELECT qid, doc_id, round(sum(1.0 / (60 + rank)), 8) AS score FROM (
            SELECT item_id AS qid, doc_id, rank FROM ktop UNION ALL SELECT qid, doc_id, rank FROM vtop)
          GROUP BY qid, doc_id)
"""

_RERANK_CTE = f"""
{_FUSE_CTE},
qidf AS (SELECT qt.item_id AS qid, qt.term,
                ln(1.0 + ((SELECT n FROM stats) - coalesce(df, 0) + 0.5) / (coalesce(df, 0) + 0.5)) AS idf
         FROM qt LEFT JOIN dfq USING (term)),
tot AS (SELECT qid, sum(idf) AS idf_all FROM qidf GROUP BY qid),
hit AS (SELECT f.qid, f.doc_id, sum(qidf.idf) AS idf_hit
        FROM fused f JOIN post p ON p.doc_id = f.doc_id JOIN qidf ON qidf.qid = f.qid AND qidf.term = p.term
        GROUP BY f.qid, f.doc_id),
rr AS (SELECT f.qid, f.doc_id, f.score,
              round(4.0 * coalesce(hit.idf_hit / nullif(tot.idf_all, 0), 0.0), 8) AS rerank_score
       FROM fused f LEFT JOIN hit USING (qid, doc_id) LEFT JOIN tot USING (qid)),
rtop AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY rerank_score DESC, score DESC, doc_id)
         AS INTEGER) AS rank FROM rr) WHERE rank <= {RERANK_TOP})
"""


# ---- queries ------------------------------------------------------------------------

@register("keyword_search", bench=True, oracle=f"""
WITH {_BM25_CTE},
top AS ({_rank_sql('bm', 'item_id', 'doc_id', KW_TOP)})
SELECT item_id, rank, doc_id, score, substr(translate(text, chr(10), ' '), 1, 1000) AS snippet
FROM top JOIN documents USING (doc_id)
""")
def keyword_search(spark, sf_dir):
    return R.keyword_search(_docs(spark, sf_dir), "doc_id", "text", _queries(spark, sf_dir),
                            "item_id", "text", top=KW_TOP, partitions=text_partitions(spark))


@register("keyword_search_filtered", oracle=f"""
WITH {_BM25_CTE},
top AS ({_rank_sql('bm', 'item_id', 'doc_id', KW_TOP)})
SELECT item_id, rank, doc_id, score, substr(translate(text, chr(10), ' '), 1, 1000) AS snippet
FROM top JOIN documents USING (doc_id) WHERE contains(text, 'the')
""")
def keyword_search_filtered(spark, sf_dir):
    return R.keyword_search(_docs(spark, sf_dir), "doc_id", "text", _queries(spark, sf_dir),
                            "item_id", "text", top=KW_TOP, must_contain="the", partitions=text_partitions(spark))


def _stored_index(spark, sf_dir):
    """A keyword index of two segments: documents of even id, then those of odd id."""
    path, docs = fresh_folder(spark, "keyword-index"), _docs(spark, sf_dir)
    even = F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False))
    for part in (docs.filter(even), docs.filter(~even)):
        KI.add_segment(path, part, "doc_id", "text", partitions=text_partitions(spark))
    return path


@register("keyword_index_search", oracle=f"""
WITH {_BM25_CTE},
top AS ({_rank_sql('bm', 'item_id', 'doc_id', KW_TOP)})
SELECT item_id, rank, doc_id, score, substr(translate(text, chr(10), ' '), 1, 1000) AS snippet
FROM top JOIN documents USING (doc_id)
""")
def keyword_index_search(spark, sf_dir):
    """R1 over the stored block-max index, filled in two segments."""
    hits = KI.search(spark, _stored_index(spark, sf_dir), _queries(spark, sf_dir), "item_id", "text", KW_TOP).hits
    shown = _docs(spark, sf_dir).select("doc_id", X.snippet("text").alias("snippet"))
    return hits.select(F.col("qid").alias("item_id"), "rank", F.col("did").alias("doc_id"), "score").join(shown, "doc_id")


@register("keyword_index_turns", oracle=f"""
WITH first AS (SELECT conv_id AS item_id, text FROM conversations WHERE turn = 0),
{_BM25_CTE.replace('FROM benchmark', 'FROM first')},
top AS ({_rank_sql('bm', 'item_id', 'doc_id', KW_TOP)})
SELECT item_id AS conv_id, rank, doc_id, score, true AS blocks_skipped FROM top
""")
def keyword_index_turns(spark, sf_dir):
    """A second query set, the first turn of every conversation, on the index that
    answered the first; no text is read for it and blocks are skipped."""
    path = _stored_index(spark, sf_dir)
    KI.search(spark, path, _queries(spark, sf_dir), "item_id", "text", KW_TOP)
    turns = Tables(spark, sf_dir).conversations.filter("turn = 0").select("conv_id", "text")
    found = KI.search(spark, path, turns, "conv_id", "text", KW_TOP)
    return found.hits.select(F.col("qid").alias("conv_id"), "rank", F.col("did").alias("doc_id"), "score", F.lit(found.read < found.blocks).alias("blocks_skipped"))


@register("vector_search", bench=True, oracle=f"""
WITH e AS (SELECT vec_id, label, CAST(x AS DOUBLE) AS x, pos
           FROM (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)),
c AS (SELECT label, pos, avg(x) AS x FROM e GROUP BY label, pos),
cn AS (SELECT label, sqrt(sum(x * x)) AS n FROM c GROUP BY label),
vn AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM e GROUP BY vec_id),
s AS (SELECT CAST(c.label AS BIGINT) AS qid, e.vec_id AS vid,
             round(sum(c.x * e.x) / (any_value(cn.n) * any_value(vn.n)), 8) AS score
      FROM c JOIN e USING (pos) JOIN cn ON cn.label = c.label JOIN vn ON vn.vec_id = e.vec_id
      GROUP BY c.label, e.vec_id)
SELECT qid, rank, vid, score FROM ({_rank_sql('s', 'qid', 'vid', VEC_K)})
""")
def vector_search(spark, sf_dir):
    emb = Tables(spark, sf_dir).embeddings
    q = R.centroids(emb, "label", "embedding").withColumn("label", F.col("label").cast("long"))
    return R.vector_search(emb, "vec_id", "embedding", q, "label", "centroid", k=VEC_K)


_EXACT_SQL = f"""
WITH q AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 100 = 0),
s AS (SELECT q.vec_id AS qid, v.vec_id AS vid, round(list_dot_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[])
             / (sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[]))
                * sqrt(list_dot_product(v.embedding::DOUBLE[], v.embedding::DOUBLE[]))), 8) AS score
      FROM q, embeddings v)
SELECT qid, rank, vid, score FROM ({_rank_sql('s', 'qid', 'vid', VEC_K)})
"""


def _hundredths(emb):
    """The query set of the searches: every vector whose id is divisible by 100."""
    return emb.filter(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("q_id"), F.col("embedding").alias("q_vec"))


@register("vector_search_ivf", oracle=_EXACT_SQL)
def vector_search_ivf(spark, sf_dir):
    """The written inverted-file index, searched until no unread cell can hold a
    better vector, so the result is the exhaustive one."""
    emb = Tables(spark, sf_dir).embeddings
    index = VI.build_index(emb, "vec_id", "embedding")
    return VI.search(index, _hundredths(emb), "q_id", "q_vec", k=VEC_K)[0]


@register("vector_search_ivf_recall", oracle="""
SELECT count(*) AS n_queries, true AS recall_reached, true AS cells_skipped FROM embeddings WHERE vec_id % 100 = 0
""")
def vector_search_ivf_recall(spark, sf_dir):
    """R2b with an expected recall of 0.95: whether 0.9 of the exhaustive result is found, and
    whether vectors were left unread."""
    emb = Tables(spark, sf_dir).embeddings
    index, q = VI.build_index(emb, "vec_id", "embedding"), _hundredths(emb)
    got, report = VI.search(index, q, "q_id", "q_vec", k=VEC_K, recall=0.95)
    exact = R.vector_search(emb, "vec_id", "embedding", q, "q_id", "q_vec", k=VEC_K).select("qid", "vid")
    found = exact.join(got.select("qid", "vid", F.lit(1).alias("hit")), ["qid", "vid"], "left")
    return found.agg(F.countDistinct("qid").alias("n_queries"), (F.sum(F.coalesce("hit", F.lit(0))) >= 0.9 * F.count(F.lit(1))).alias("recall_reached"),
                     F.lit(report.share < 1).alias("cells_skipped"))


@register("vector_search_lsh", oracle=_EXACT_SQL)
def vector_search_lsh(spark, sf_dir):
    """R2b by sign sketches."""
    emb = Tables(spark, sf_dir).embeddings
    return R.vector_search_lsh(emb, "vec_id", "embedding", _hundredths(emb), "q_id", "q_vec", k=VEC_K)


def _doc_vectors(spark, sf_dir):
    return spread(_docs(spark, sf_dir)).select("doc_id", R.hashed_embedding("text").alias("embedding"))


def _doc_vector_hits(spark, sf_dir, k=VEC_K, vectors=None):
    q = _queries(spark, sf_dir).select("item_id", R.hashed_embedding("text").alias("qvec"))
    v = vectors if vectors is not None else _doc_vectors(spark, sf_dir)
    return R.vector_search(v, "doc_id", "embedding", q, "item_id", "qvec", k=k)


@register("embed_documents", oracle=sql_hashed_embedding("documents", "doc_id", "text", R.HASH_DIM))
def embed_documents(spark, sf_dir):
    return _doc_vectors(spark, sf_dir)


@register("doc_vector_search", oracle=f"""
WITH {_DOCVEC_CTE}
SELECT qid, rank, doc_id AS vid, score FROM vtop
""")
def doc_vector_search(spark, sf_dir):
    return _doc_vector_hits(spark, sf_dir)


def _index(spark, sf_dir):
    """One BM25 index (one pass over the text) shared by ranking and rerank."""
    return R.bm25_index(_docs(spark, sf_dir), "doc_id", "text", _queries(spark, sf_dir), "item_id", "text",
                        text_partitions(spark))


def _fused(spark, sf_dir, idx):
    kw = R.bm25_top_k(idx, "doc_id", "item_id", FUSE_DEPTH)
    vec = _doc_vector_hits(spark, sf_dir).withColumnRenamed("vid", "doc_id")
    return R.rrf(kw.withColumnRenamed("item_id", "qid"), vec)


@register("hybrid_rrf", oracle=f"""
WITH {_FUSE_CTE}
SELECT qid, rank, doc_id, score FROM ({_rank_sql('fused', 'qid', 'doc_id', HYBRID_TOP)})
""")
def hybrid_rrf(spark, sf_dir):
    fused = _fused(spark, sf_dir, _index(spark, sf_dir))
    return R.top_k(fused, "qid", "doc_id", HYBRID_TOP).select("qid", "rank", "doc_id", "score")


def _reranked(spark, sf_dir, idx):
    return R.coverage_rerank(_fused(spark, sf_dir, idx), idx, "doc_id", "item_id", top=RERANK_TOP)


@register("rerank_topk", oracle=f"""
WITH {_RERANK_CTE}
SELECT qid, rank, doc_id, score, rerank_score FROM rtop
""")
def rerank_topk(spark, sf_dir):
    return _reranked(spark, sf_dir, _index(spark, sf_dir))


def _overlap(pairs):
    """A stand-in for a reranking model: 4 x shared words / all words of query and text."""
    import regex

    out = []
    for q, d in pairs:
        a, b = (set(regex.split(r"[^\p{L}\p{N}]+", x.lower())) - {""} for x in (q, d))
        out.append(4.0 * len(a & b) / len(a | b) if a | b else 0.0)
    return out


@register("rerank_model", oracle=f"""
WITH {_FUSE_CTE},
tx AS (SELECT f.qid, f.doc_id, f.score, list_distinct({sql_tokens('d.text')}) AS dt, list_distinct({sql_tokens('b.text')}) AS bt
       FROM fused f JOIN documents d USING (doc_id) JOIN benchmark b ON b.item_id = f.qid),
rr AS (SELECT qid, doc_id, score, round(coalesce(4.0 * len(list_intersect(dt, bt))
              / nullif(len(dt) + len(bt) - len(list_intersect(dt, bt)), 0), 0.0), 8) AS rerank_score FROM tx)
SELECT qid, rank, doc_id, score, rerank_score, CAST(NULL AS VARCHAR) AS error FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY rerank_score DESC, score DESC, doc_id) AS INTEGER) AS rank FROM rr)
WHERE rank <= {RERANK_TOP}
""")
def rerank_model(spark, sf_dir):
    """R4 with a pluggable model over (query, text) pairs of all fused candidates."""
    fused = _fused(spark, sf_dir, _index(spark, sf_dir))
    return R.rerank_with(fused, _docs(spark, sf_dir), "doc_id", "text", _queries(spark, sf_dir), "item_id", "text", _overlap, top=RERANK_TOP)


@register("rag_prompt", oracle=f"""
WITH {_RERANK_CTE},
ctx AS (SELECT qid, substr(translate(text, chr(10), ' '), 1, 1000) AS context
        FROM rtop JOIN documents USING (doc_id) WHERE rank = 1)
SELECT item_id AS qid, {_sql_lit(R.RAG_HEAD)} || coalesce(context, '') || {_sql_lit(R.RAG_MID)} || text
       || {_sql_lit(R.RAG_TAIL)} AS prompt
FROM benchmark LEFT JOIN ctx ON ctx.qid = benchmark.item_id
""")
def rag_prompt(spark, sf_dir):
    shown = _docs(spark, sf_dir).select("doc_id", X.snippet("text").alias("snippet"))
    return R.rag_prompt(_reranked(spark, sf_dir, _index(spark, sf_dir)), shown, "doc_id", _queries(spark, sf_dir),
                        "item_id", "text")


@register("index_validate", oracle="""
SELECT vec_id, vec_id IS NOT NULL AS has_key, count(*) OVER (PARTITION BY vec_id) = 1 AS unique_key,
       coalesce(len(embedding) = 64, false) AS dim_ok
FROM embeddings
""")
def index_validate(spark, sf_dir):
    return R.validate_index(Tables(spark, sf_dir).embeddings, "vec_id", "embedding", 64)


@register("sql_query", oracle="""
SELECT label, count(*) AS n, min(vec_id) AS first_id FROM embeddings WHERE label >= 2 GROUP BY label
""")
def sql_query(spark, sf_dir):
    """SQL with parameters over any set of stored items."""
    items = Tables(spark, sf_dir).embeddings
    return R.query_items(items, "SELECT label, count(*) AS n, min(vec_id) AS first_id FROM {items} WHERE label >= :least GROUP BY label", least=2)

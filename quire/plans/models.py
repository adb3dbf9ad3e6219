"""Trained-classifier queries. Fitting has no SQL form, so the results state what SQL can
check: rows, supports, ranges, and whether each class is found more often than by
chance. The model is saved (E6) and loaded again before it scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import count_model as CM
from quire.operators import model as MD
from quire.operators import sampling as S
from quire.plans.common import sql_tokens
from quire.plans.registry import register
from quire.session import cut_lineage, fresh_folder
from quire.sources.tables import Tables


_SPLIT_SQL = """
s AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42'), doc_id) - 1 AS r,
             count(*) OVER (PARTITION BY lang) AS n FROM documents)
"""


def _split(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "text", F.col("lang").alias("label"))
    return S.train_test_split(d, "label", "doc_id", "42")


def _fit_and_score(spark, sf_dir):
    """(scores of the test rows with their labels, the test rows)."""
    sp = cut_lineage(_split(spark, sf_dir), "split")
    path = fresh_folder(spark, "model")
    MD.save_model(MD.train_classifier(sp.filter(F.col("set") == "train"), "text", "label"), path)
    test = sp.filter(F.col("set") == "test")
    return MD.score(MD.load_model(path), test, "doc_id").join(test.select("doc_id", "label"), "doc_id")


@register("train_classifier", oracle=f"""
WITH {_SPLIT_SQL}
SELECT lang AS label, count(*) AS n_test, true AS above_chance FROM s WHERE r >= floor(n * 0.7) GROUP BY lang
""")
def train_classifier(spark, sf_dir):
    """Fit on the train split; per class the number of test rows, and whether more of them are
    right than a guess among the four classes would get."""
    s = _fit_and_score(spark, sf_dir)
    right = F.avg((F.col("label") == F.col("doc_type")).cast("double"))
    return s.groupBy("label").agg(F.count(F.lit(1)).alias("n_test"), (right > 0.25).alias("above_chance"))


@register("score_classifier", oracle=f"""
WITH {_SPLIT_SQL}
SELECT doc_id, true AS known_type, true AS confidence_in_range FROM s WHERE r >= floor(n * 0.7)
""")
def score_classifier(spark, sf_dir):
    s = _fit_and_score(spark, sf_dir)
    return s.select("doc_id", F.col("doc_type").isin("de", "en", "es", "fr").alias("known_type"),
                    F.col("confidence").between(0.25, 1.0).alias("confidence_in_range"))


@register("count_classifier", oracle=f"""
WITH {_SPLIT_SQL},
tr AS (SELECT s.doc_id, s.lang, d.text FROM s JOIN documents d USING (doc_id) WHERE r < floor(n * 0.7) AND s.lang IS NOT NULL AND d.text IS NOT NULL),
cl AS (SELECT lang, count(*) AS docs FROM tr GROUP BY lang HAVING count(*) >= 5),
tk AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM (SELECT lang, unnest({sql_tokens('text')}) AS term FROM tr JOIN cl USING (lang)) GROUP BY lang, term),
voc AS (SELECT DISTINCT term FROM tk), tot AS (SELECT lang, sum(n) AS tokens FROM tk GROUP BY lang),
te AS MATERIALIZED (SELECT doc_id, term, count(*) AS n FROM (SELECT s.doc_id, unnest({sql_tokens('text')}) AS term FROM s JOIN documents USING (doc_id) WHERE r >= floor(s.n * 0.7))
                    WHERE term IN (SELECT term FROM voc) GROUP BY 1, 2),
w AS (SELECT voc.term, cl.lang, ln((coalesce(tk.n, 0) + 1) / (tot.tokens + (SELECT count(*) FROM voc))::DOUBLE) AS w
      FROM voc CROSS JOIN cl JOIN tot USING (lang) LEFT JOIN tk ON tk.term = voc.term AND tk.lang = cl.lang),
sc AS (SELECT te.doc_id, w.lang, sum(te.n * w.w) AS s FROM te JOIN w USING (term) GROUP BY 1, 2),
al AS (SELECT s.doc_id, cl.lang, coalesce(sc.s, 0.0) + ln(cl.docs / (SELECT sum(docs) FROM cl)::DOUBLE) AS s
       FROM s CROSS JOIN cl LEFT JOIN sc ON sc.doc_id = s.doc_id AND sc.lang = cl.lang WHERE s.r >= floor(s.n * 0.7)),
mx AS (SELECT *, max(s) OVER (PARTITION BY doc_id) AS top, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, lang) AS place FROM al)
SELECT doc_id, any_value(lang) FILTER (place = 1) AS doc_type, round(any_value(s) FILTER (place = 1), 4) AS log_score,
       round(1 / sum(exp(s - top)), 6) AS confidence
FROM mx GROUP BY doc_id
""")
def count_classifier(spark, sf_dir):
    """E3 + E4 + E6 in closed form: word counts per class, saved and loaded, then every test
    document's class, score and confidence."""
    sp = cut_lineage(_split(spark, sf_dir), "split")
    path = fresh_folder(spark, "count-model")
    CM.save(CM.fit(sp.filter(F.col("set") == "train"), "text", "label"), path)
    found = CM.score(CM.load(spark, path), sp.filter(F.col("set") == "test"), "doc_id")
    return found.select("doc_id", "doc_type", F.round("log_score", 4).alias("log_score"), F.round("confidence", 6).alias("confidence"))


@register("flatten_results", oracle="""
SELECT conv_id, CASE WHEN role = 'system' THEN 'N/A' ELSE role END AS doc_type, turn / 100.0::DOUBLE AS confidence,
       array_to_string([turn + 1, turn + 2], ',') AS pages
FROM conversations WHERE turn % 4 <> 3
""")
def flatten_results(spark, sf_dir):
    """E5 on nested results built from conversations: a turn is a classified document over
    two pages; system turns have no type, every fourth turn no region (and drops out)."""
    c = Tables(spark, sf_dir).conversations
    regions = F.when(F.col("turn") % 4 != 3, F.array(*[F.struct((F.col("turn") + k).alias("page_number")) for k in (1, 2)]))
    one = F.struct(F.when(F.col("role") != "system", F.col("role")).alias("doc_type"), (F.col("turn") / F.lit(100.0)).alias("confidence"),
                   regions.alias("bounding_regions"))
    nested = c.select("conv_id", F.array(one).alias("documents"))
    return MD.flatten_results(nested, "conv_id").withColumn("pages", F.array_join("pages", ","))

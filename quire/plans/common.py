"""Building blocks shared by the registered queries and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.classify import LANG_LABELS, LANG_RULES, UNKNOWN, keyword_classify
from quire.sources.tables import Tables

# ---- SQL fragments (DuckDB dialect) mirroring the Column helpers ----------

SQL_TOKENS = "list_filter(string_split_regex(lower({t}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"


def sql_tokens(text_expr: str) -> str:
    return SQL_TOKENS.format(t=text_expr)


def sql_hash_bucket(t: str, dim: int) -> str:
    """Token bucket as in ``retrieval.token_buckets``: md5 prefix (32 bits) mod dim."""
    return f"(CAST('0x' || substr(md5({t}), 1, 8) AS BIGINT) % {dim})"


def sql_hashed_embedding(source: str, id_col: str, text_col: str, dim: int) -> str:
    """SELECT id, embedding: the L2-normalised hashed bag of words of ``text_col``."""
    return f"""
SELECT {id_col}, list_transform(cnt, lambda x: CASE WHEN nrm > 0 THEN x / nrm ELSE 0.0 END) AS embedding
FROM (SELECT {id_col}, cnt, sqrt(list_sum(list_transform(cnt, lambda y: y * y))) AS nrm
      FROM (SELECT {id_col}, list_transform(range({dim}),
                   lambda i: CAST(len(list_filter(b, lambda y: y = i)) AS DOUBLE)) AS cnt
            FROM (SELECT {id_col}, list_transform({sql_tokens(text_col)}, lambda x: {sql_hash_bucket('x', dim)}) AS b
                  FROM {source})))
"""


def sql_str_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def sql_keyword_predict(text_expr: str = "text", rules=LANG_RULES, unknown=UNKNOWN) -> str:
    """CASE expression equal to ``keyword_predict``: arg-max hits, ties by rule order."""
    tok = sql_tokens(text_expr)
    hits = {lab: f"len(list_filter({tok}, lambda x: x IN ({sql_str_list(ws)})))"
            for lab, ws in rules.items()}
    labs = list(rules)
    parts = [f"WHEN {text_expr} IS NULL THEN NULL"]
    parts.append(f"WHEN greatest({', '.join(hits.values())}) = 0 THEN '{unknown}'")
    for i, lab in enumerate(labs):
        cond = " AND ".join(
            [f"{hits[lab]} > {hits[o]}" for o in labs[:i]]
            + [f"{hits[lab]} >= {hits[o]}" for o in labs[i + 1:]])
        parts.append(f"WHEN {cond} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


SQL_PAIRS = f"""
  SELECT doc_id, lang AS y_true, {sql_keyword_predict('text')} AS y_pred
  FROM documents
"""
SQL_LABELS = f"(VALUES {', '.join(f'({i}, {chr(39)}{x}{chr(39)})' for i, x in enumerate(LANG_LABELS))}) AS lt(label_order, label)"


def text_partitions(spark: SparkSession) -> int | None:
    """``spark.quire.textPartitions``: deal text tables out over so many partitions before
    the work on their texts. Unset for tables of many files; of use where a small table
    is stored in fewer pieces than there are cores."""
    n = spark.conf.get("spark.quire.textPartitions", None)
    return int(n) if n else None


def spread(docs: DataFrame) -> DataFrame:
    n = text_partitions(docs.sparkSession)
    return docs.repartition(n) if n else docs


# ---- Spark side -------------------------------------------------------------

def doc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, y_true, y_pred) over all documents; J5 keeps pairs with both sides."""
    # the prediction is null exactly when the text is: filter on the raw
    # columns so no predicate over the classifier output is pushed into the scan
    docs = (Tables(spark, sf_dir).documents.select("doc_id", "text", "lang")
            .filter(F.col("lang").isNotNull() & F.col("text").isNotNull()))
    pred = keyword_classify(spread(docs), keep=["lang"])
    return pred.select("doc_id", F.col("lang").alias("y_true"), F.col("prediction").alias("y_pred"))

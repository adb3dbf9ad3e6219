"""A classifier fitted by one aggregate (E3, E4): multinomial word counts with smoothing.

Fitting is counting, so models of parts of the data add up to the model of all of it, and a
prediction can be computed by hand: log prior of the class plus, for every word of the
document that the model knows, log((count of the word in the class + 1) / (words of the
class + words known)).

The model is two tables: ``terms`` (term, counts per class, in the order of the classes) and
``classes`` (label, docs, tokens). Only the second, a row a class, reaches the driver. A
frequent word is one row of ``terms``; documents meet it by a join whose other side has a
row per document and word.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import tokens
from quire.operators.retrieval import TERM_BROADCAST_BYTES
from quire.session import cut_lineage
from quire.sources.files import of_qualifying_classes


class CountModel(NamedTuple):
    terms: DataFrame     # (term, counts array<long>)
    classes: DataFrame   # (label, docs, tokens)

    def labels(self) -> list:
        return [r["label"] for r in self.classes.orderBy("label").collect()]


def word_counts(docs: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys..., term, n) of the tokens of ``text``; a row's tokens meet in its own map task."""
    return docs.select(*keys, F.explode(tokens(text)).alias("term")).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("n"))


def fit(train: DataFrame, text: str = "text", label: str = "label", min_docs: int = 5) -> CountModel:
    """Count the words of every class with at least ``min_docs`` training documents. Rows
    without label or text train nothing."""
    rows = train.select(F.col(label).alias("label"), F.col(text).alias("text")).dropna()
    rows = of_qualifying_classes(rows, "label", min_docs)
    counts = cut_lineage(word_counts(rows, ["label"], "text"), "class-words")
    classes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("docs")).join(counts.groupBy("label").agg(F.sum("n").alias("tokens")), "label", "left")
    classes = cut_lineage(classes.fillna(0, ["tokens"]), "classes")
    labels = [r["label"] for r in classes.orderBy("label").collect()]
    per_class = F.array(*[F.coalesce(F.sum(F.when(F.col("label") == x, F.col("n"))), F.lit(0)) for x in labels]) if labels else F.array().cast("array<bigint>")
    return CountModel(cut_lineage(counts.groupBy("term").agg(per_class.alias("counts")), "class-terms"), classes)


def merge(a: CountModel, b: CountModel) -> CountModel:
    """The model of the training rows of both; a class either has is a class of the result."""
    rows = a.classes.unionByName(b.classes).groupBy("label").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    classes = cut_lineage(rows, "classes")
    labels = [r["label"] for r in classes.orderBy("label").collect()]

    def widened(m: CountModel) -> DataFrame:
        own = m.labels()
        return m.terms.select("term", F.array(*[F.get("counts", own.index(x)) if x in own else F.lit(0).cast("long") for x in labels]).alias("counts"))

    both = widened(a).unionByName(widened(b))
    total = F.array(*[F.sum(F.get("counts", i)) for i in range(len(labels))])
    return CountModel(cut_lineage(both.groupBy("term").agg(total.alias("counts")), "class-terms"), classes)


def save(model: CountModel, path: str) -> None:
    model.terms.write.mode("overwrite").parquet(f"{path}/terms")
    model.classes.write.mode("overwrite").parquet(f"{path}/classes")


def load(spark: SparkSession, path: str) -> CountModel:
    return CountModel(spark.read.parquet(f"{path}/terms"), spark.read.parquet(f"{path}/classes"))


def score(model: CountModel, docs: DataFrame, id_col: str, text: str = "text") -> DataFrame:
    """(id, doc_type, log_score, confidence): the class of the largest score, ties by label;
    its probability among the classes. Unknown words count for nothing; a document without
    a known word (a null text too) gets the most frequent class. Ids must be distinct."""
    classes = model.classes.orderBy("label").collect()
    kind = docs.schema[id_col].dataType.simpleString()
    if not classes:
        return docs.sparkSession.createDataFrame([], f"{id_col} {kind}, doc_type string, log_score double, confidence double")
    size = model.terms.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("term") + 8 * len(classes) + 32), F.lit(0)).alias("bytes")).first()
    weights = model.terms.select("term", *[F.log((F.get("counts", i) + 1) / F.lit(float(c["tokens"] + size["n"]))).alias(f"w{i}") for i, c in enumerate(classes)])
    if size["bytes"] <= TERM_BROADCAST_BYTES:
        weights = F.broadcast(weights)
    sums = word_counts(docs, [id_col], text).join(weights, "term").groupBy(id_col).agg(*[F.sum(F.col("n") * F.col(f"w{i}")).alias(f"s{i}") for i in range(len(classes))])
    n = sum(c["docs"] for c in classes)
    total = [F.coalesce(F.col(f"s{i}"), F.lit(0.0)) + F.log(F.lit(c["docs"] / n)) for i, c in enumerate(classes)]
    best = F.greatest(*[F.struct(t.alias("log_score"), F.lit(-i).alias("order"), F.lit(c["label"]).alias("doc_type")) for i, (t, c) in enumerate(zip(total, classes, strict=True))])
    out = docs.select(id_col).join(sums, id_col, "left").select(id_col, best.alias("best"), F.array(*total).alias("all"))
    share = 1 / F.aggregate("all", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best.log_score")))
    return out.select(id_col, F.col("best.doc_type").alias("doc_type"), F.col("best.log_score").alias("log_score"), share.alias("confidence"))

"""Trained document classifier on MLlib.

Fitting is distributed by MLlib (feature hashing is per row; IDF and
logistic regression aggregate with ``treeAggregate``), so nothing is
collected but model coefficients. Only classes with at least
``min_docs`` training documents take part (the class-list rule of S5).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import cut_lineage
from quire.sources.files import of_qualifying_classes


def train_classifier(train: DataFrame, text: str = "text", label: str = "label",
                     min_docs: int = 5, num_features: int = 1 << 18, max_iter: int = 50) -> PipelineModel:
    """Tokens -> hashed TF -> IDF -> multinomial logistic regression."""
    data = of_qualifying_classes(train, label, min_docs).select(text, label)
    index = StringIndexer(inputCol=label, outputCol="_y", stringOrderType="alphabetAsc").fit(data)
    words = RegexTokenizer(inputCol=text, outputCol="_tok", pattern=r"[^\p{L}\p{N}]+", toLowercase=True)
    hashed = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features)
    # IDF and the regression read the counts several times: texts are tokenized once
    counts = cut_lineage(hashed.transform(words.transform(index.transform(data))).select("_y", "_tf"), "hashed-counts")
    idf = IDF(inputCol="_tf", outputCol="_x").fit(counts)
    fitted = LogisticRegression(featuresCol="_x", labelCol="_y", maxIter=max_iter, family="multinomial").fit(idf.transform(counts))
    return PipelineModel(stages=[index, words, hashed, idf, fitted,
        IndexToString(inputCol="prediction", outputCol="doc_type", labels=index.labels)])


def score(model: PipelineModel, docs: DataFrame, id_col: str, text: str = "text") -> DataFrame:
    """(id, doc_type, confidence) — confidence = the winning class probability."""
    out = model.transform(docs.select(id_col, text))
    return out.select(id_col, "doc_type",
                      F.array_max(vector_to_array("probability")).alias("confidence"))


def save_model(model: PipelineModel, path: str) -> None:
    """MLlib's own format (no pickle)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def flatten_results(results: DataFrame, key: str) -> DataFrame:
    """E5: ``documents[] {doc_type, confidence, bounding_regions[].page_number}`` ->
    one row per classified document with its pages; documents without regions drop out."""
    d = results.select(key, F.explode("documents").alias("d"))
    return (d.select(key, F.coalesce("d.doc_type", F.lit("N/A")).alias("doc_type"),
                     F.col("d.confidence").alias("confidence"),
                     F.transform(F.coalesce("d.bounding_regions", F.array()), lambda r: r["page_number"])
                     .alias("pages"))
            .filter(F.size("pages") > 0))

"""A training corpus from ``documents``: language ID, near-duplicate removal,
benchmark decontamination, mixing to target weights, and token ids as binary
segments. Each stage applies one operator of ``quire.llm`` to all that its
predecessor kept; it is written as Parquet and read again as the next one's
documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import byte_ids, decontaminate, hyper_lang, mixing, order_minhash
from quire.llm.common import written
from quire.llm.queries import tokenizer_path
from quire.sources.tables import read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without text or letters go: no language can be told. Null ids and repeated rows
    stay; an empty table stays empty, here and in every stage."""
    return hyper_lang.keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that of the least id (null last); of
    repeated rows one stays. Texts without words are classes of their own."""
    return order_minhash.dedupe(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; rows of equal id are judged one by one, null benchmark texts
    match nothing."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's rate says; a null source is a source of its
    own, equal ids get equal draws, a null id draws as empty text."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids written as binary segments; a row per document, read back from them,
    in the order of ids (null first), a hash of the text between equal ids."""
    return byte_ids.encode_documents(docs, tokenizer_path())


STAGES = [
    ("language id", language_id),
    ("near dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mix", source_mix),
    ("token ids", token_ids),
]

#: Language profiles, alignment and the tokenizer have no SQL form; a brute-force run is tested instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs

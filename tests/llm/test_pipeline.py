"""The pipeline against a brute-force run of its stages."""

import zlib

import numpy as np
from tokenizers import Tokenizer

import __spark_entry__ as se
import corpus_pipeline
from quire.llm.queries import tokenizer_path
from tests.conftest import SF_SMALL
from tests.llm import test_decontaminate, test_mixing, test_order_minhash
from tests.llm.fixtures import documents


def test_stages_equal_brute_force(spark, tmp_path):
    rows = [r for r in documents(12, 30) if r[0] is not None and r[0] != 3]
    bench = [(1, rows[5][1].replace("\n", " "))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).orderBy("start").collect()

    left = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    classes = test_order_minhash.brute(left)
    left = [r for r, c in zip(left, classes, strict=True) if r[0] == c]
    bad = {x[0] for x in test_decontaminate.brute(left, bench) if x[5]}
    assert bad
    left = [r for r in left if r[0] not in bad]
    sizes: dict = {}
    for r in left:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].split())
    target = test_mixing.water(sizes)
    encode = Tokenizer.from_file(tokenizer_path()).encode
    by: dict = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for r in left:
        rate = target[r[3]] / sizes[r[3]]
        assert int(rate) <= len(by.get(r[0], [])) <= int(rate) + 1
        ids = [*encode(r[1], add_special_tokens=False).ids, 2]
        for x in by.pop(r[0], []):
            assert (x["n_tokens"], x["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert not by
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]


def test_null_and_repeated_ids_long_texts_and_clashing_columns(spark, tmp_path):
    rows = [r for r in documents(12, 30) if r[0] != 12]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = frame.selectExpr("*", "1 as score", "'x' as id", "5 as n", "4 as _target", "3 as c0")
    extra.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, rows[5][1].replace("\n", " ")), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).orderBy("start").collect()
    left = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    ids = {}
    for r in got:
        ids[r["doc_id"]] = ids.get(r["doc_id"], 0) + 1
    assert set(ids) <= {r[0] for r in left} and None in ids  # the row of no id is kept
    assert ids.get(3, 0) <= 3 and rows[5][0] not in ids  # a repeated row counts once, at three copies at most
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]


def test_stages_keep_the_columns_and_registered():
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5 and "pipeline" in se.queries()


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_runs_on_the_given_tables(spark):
    assert se.queries()["pipeline"](spark, SF_SMALL).count() > 0

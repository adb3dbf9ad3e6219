import hashlib
import random
import re

import pyarrow.parquet as pq
import __spark_entry__ as se
from quire.llm import decontaminate as D
from quire.llm.decontaminate import contamination_report, decontaminate
from tests.llm.fixtures import EN, clashing, documents, frame, prose

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, items):
    out = []
    for row in docs:
        own = words(row[1])
        hit, found = set(), set()
        for item, text in items:
            w = words(text)
            width = min(13, len(w))
            for k in range(len(w) - width + 1) if w else ():
                for i in range(len(own) - width + 1):
                    if own[i:i + width] == w[k:k + width]:
                        hit |= set(range(i, i + width))
                        found |= {str(item)} - {"None"}
        ids = ",".join(sorted(found))
        out.append((row[0], len(own), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=repr)


def cases(spark):
    rng = random.Random(3)
    docs = documents(1, 25)
    tests = [(9, prose(rng, EN, 30)), (10, prose(rng, EN, 40)), (2, "two words"), (None, prose(rng, EN, 15)), (5, None), (6, " .. "), (9, prose(rng, EN, 14))]
    text = tests[1][1].split()
    docs += [(100, "before " + " ".join(text).upper() + " after", "en", "s", 0), (101, " ".join(text[:12]), "en", "s", 0),
             (102, " ".join(text[:20]) + " " + prose(rng, EN, 900), "en", "s", 0), (103, "so Two-Words two words", "en", "s", 0),
             (104, tests[3][1], "en", "s", 0), (105, " ".join(text[:20]), "en", "s", 0), (105, " ".join(text[:20]), "en", "s", 0)]
    return docs, tests


def test_report_equals_brute_force(spark):
    docs, tests = cases(spark)
    got = contamination_report(frame(spark, docs), spark.createDataFrame(tests, "item_id long, text string"))
    rows = [tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()]
    assert sorted(rows, key=repr) == brute(docs, tests)


def test_proximity_finds_a_passage_with_a_word_put_in(spark):
    docs, tests = cases(spark)
    text = tests[1][1].split()
    near = " ".join(text[:6] + ["xyzzy"] + text[6:13])
    got = contamination_report(frame(spark, [(1, near, "en", "s", 0), (2, "quite other words", "en", "s", 0)]),
                               spark.createDataFrame(tests[1:2], "item_id long, text string"))
    assert [(r["n_items"], r["n_near"] > 0) for r in got.orderBy("doc_id").collect()] == [(0, True), (0, False)]


def test_filter_keeps_whole_rows_with_any_columns(spark):
    docs, tests = cases(spark)
    df = clashing(frame(spark, docs))
    left = decontaminate(df, spark.createDataFrame(tests, "item_id long, text string"), segment_bytes=2000, block_bytes=100)
    assert left.columns == df.columns
    bad = [r[0] for r in brute(docs, tests) if r[5]]
    assert sorted(str(r[0]) for r in left.collect()) == sorted(str(d[0]) for d in docs if d[0] not in bad)


def test_empty_tables(spark):
    docs, tests = cases(spark)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert contamination_report(frame(spark, []), empty).count() == 0
    assert contamination_report(frame(spark, docs), empty).filter("n_hit > 0").count() == 0


def test_registered():
    assert "op1_decontaminate" in se.queries() and "op1_decontaminate" in se.oracle_sql()


def test_index_rows_and_row_groups_are_small(spark):
    rng = random.Random(5)
    docs = frame(spark, [(k, prose(rng, EN, 4000), "en", "s", 0) for k in range(600)]).coalesce(1)
    index = D.written_index(docs)
    sizes = [4 * (len(r["postings"]) + 2 * len(r["terms"])) for r in index.select("postings", "terms").collect()]
    assert len(sizes) > 8 and max(sizes) < 4 << 20
    groups = [g for f in index.inputFiles() for m in [pq.ParquetFile(f.removeprefix("file://")).metadata] for g in range(m.num_row_groups)]
    assert len(groups) > 1


def test_a_term_of_many_windows_is_sent_once():
    windows = D.item_windows([("a", "x y x y x y"), ("b", "y x y"), ("c", None)], 3)
    assert len(windows.terms) == 2 and {w: at.tolist() for w, (at, _) in windows.by_width.items()}.keys() == {3}
    at, items = windows.by_width[3]
    assert items.tolist() == ["a"] * 4 + ["b"] and (at[0] == at[2]).all() and (at[1] == at[4]).all()
    assert D.item_windows([], 3).terms.size == 0

"""Layout files: written where missing, scanned with their rejects, taken by a stream; named class lists."""

import os

import pytest
from pyspark.sql import functions as F

from quire.sources import files as FS
from quire.sources import layouts as LY
from quire.streaming import incremental as S

GOOD = '{"status": "succeeded", "analyzeResult": {"content": "%s", "paragraphs": [{"content": "%s"}]}}'


def bodies(spark, rows):
    return spark.createDataFrame(rows, "document string, body string")


def stems(df):
    return sorted(os.path.basename(r["file"]).removesuffix(LY.SUFFIX) for r in df.select("file").collect())


def test_scan_with_rejects(spark, tmp_dir):
    rows = [("memo/a.png", GOOD % ("x\\ny", "x")), ("memo/b.png", '{"status": "succeeded", "analyzeRes'), ("mémo 1/c+d.png", GOOD % ("ü", "ü")),
            ("memo/e.png", '{"status": "running"}'), ("memo/f.png", '{"status": "succeeded"}'), ("memo/g.png", None), ("memo/h.png", "[1, 2"), ("memo/i.png", '{"other": 1}')]
    done = LY.write_layouts(bodies(spark, rows), tmp_dir)
    assert done.count() == len(rows) - 1  # a null body is no file
    with open(f"{tmp_dir}/memo/ignored.json", "w") as f:
        f.write("{broken")
    scan = LY.scan_layouts(spark, tmp_dir)
    assert {r["content"] for r in scan.layouts.select("analyzeResult.content").collect()} == {"x\ny", "ü"}
    got = {os.path.basename(r["file"])[0]: (r["reason"], r["body"]) for r in scan.rejects.collect()}
    assert got == {"b": ("not valid JSON", rows[1][1]), "e": ("status running", None), "f": ("no result", None),
                   "h": ("not valid JSON", "[1, 2"), "i": ("status missing", None)}


def test_files_that_are_there_stay_unless_overwritten(spark, tmp_dir):
    LY.write_layouts(bodies(spark, [("m/a", GOOD % ("old", "")), ("m/b", GOOD % ("old", ""))]), tmp_dir)
    new = bodies(spark, [("m/a", GOOD % ("new", "")), ("m/c", GOOD % ("new", ""))])

    def contents():
        return {LY_name(r): r["analyzeResult"]["content"] for r in LY.scan_layouts(spark, tmp_dir).layouts.collect()}

    def LY_name(r):
        return os.path.basename(r["file"])[0]

    assert [r["document"] for r in LY.write_layouts(new, tmp_dir).collect()] == ["m/c"]
    assert contents() == {"a": "old", "b": "old", "c": "new"}
    assert LY.write_layouts(new, tmp_dir, overwrite=True).count() == 2
    assert contents() == {"a": "new", "b": "old", "c": "new"}
    assert not [f for _, _, fs in os.walk(tmp_dir) for f in fs if f.startswith(".") and not f.endswith(".crc")]


def test_scan_of_an_empty_folder(spark, tmp_dir):
    scan = LY.scan_layouts(spark, tmp_dir)
    assert scan.layouts.count() == 0 and scan.rejects.count() == 0
    assert LY.listing(spark, f"{tmp_dir}/nowhere").count() == 0


def test_stream_takes_new_files_and_keeps_rejects(spark, tmp_dir):
    src, sink, ck = (f"{tmp_dir}/{x}" for x in ("in", "sink", "ck"))
    LY.write_layouts(bodies(spark, [("m/a", GOOD % ("a", "a")), ("m/b", "{broken")]), src)
    assert S.ingest_layouts(spark, src, sink, ck) == 2
    LY.write_layouts(bodies(spark, [("m/a", GOOD % ("changed", "")), ("m/c", GOOD % ("c", "c")), ("m/d", '{"status": "failed"}')]), src)
    assert S.ingest_layouts(spark, src, sink, ck) == 2
    assert S.ingest_layouts(spark, src, sink, ck) == 0
    good, bad = S.ingested(spark, sink)
    assert stems(good) == ["a", "c"]
    assert {(os.path.basename(r["file"])[0], r["reason"], r["batch"]) for r in bad.collect()} == {("b", "not valid JSON", 0), ("d", "status failed", 1)}
    assert S.batches(spark, sink) == [0, 1]


def test_class_lists_by_name(spark, tmp_dir):
    pairs = [("file folder", f"ff/{i}.png") for i in range(40)] + [("mémo+1", f"m/{i} ü.png") for i in range(6)] + [("rare", "r.png")]
    df = spark.createDataFrame(pairs, "class string, path string").repartition(5)
    FS.write_class_lists(df, "class", "path", f"{tmp_dir}/lists")
    back = FS.read_class_lists(spark, f"{tmp_dir}/lists")
    assert sorted((r["class"], r["file"]) for r in back.select("class", "file").collect()) == sorted(p for p in pairs if p[0] != "rare")
    # a folder of an attempt that did not end is not read
    os.makedirs(f"{tmp_dir}/lists/lost")
    with open(f"{tmp_dir}/lists/lost/file folder.jsonl", "w") as f:
        f.write('{"file": "twice"}\n')
    assert FS.read_class_lists(spark, f"{tmp_dir}/lists").filter(F.col("file") == "twice").count() == 0


def test_a_class_name_with_a_slash_is_refused(spark, tmp_dir):
    df = spark.createDataFrame([("a/b", f"{i}") for i in range(5)], "class string, path string")
    with pytest.raises(ValueError, match="slash"):
        FS.write_class_lists(df, "class", "path", f"{tmp_dir}/lists")


def test_small_files_are_read_many_to_a_task(spark, tmp_dir, monkeypatch):
    name, seen, plain = "spark.sql.files.openCostInBytes", [], LY.cut_lineage
    before = spark.conf.get(name)
    monkeypatch.setattr(LY, "cut_lineage", lambda *a: seen.append(spark.conf.get(name)) or plain(*a))
    LY.write_layouts(bodies(spark, [("m/a", GOOD % ("a", "a")), ("m/b", "{broken")]), tmp_dir)
    scan = LY.scan_layouts(spark, tmp_dir)
    assert seen == ["65536"] * 2 and spark.conf.get(name) == before
    assert scan.layouts.count() == 1 and scan.rejects.count() == 1


def test_files_are_listed_by_tasks_as_spark_lists_them(spark, tmp_dir):
    rows = [("memo/a.png", GOOD % ("a", "a")), ("mémo 1/%41 b+c.png", GOOD % ("b", "b")), ("x=1/_k=2/c.png", "{}"), ("_no/d.png", "{}"), (".no/e.png", "{}"), ("memo/_f.png", "{}"), ("memo/.g.png", "{}")]
    LY.write_layouts(bodies(spark, rows), tmp_dir)
    open(f"{tmp_dir}/memo/empty.png.ocr.json", "w").close()
    found = LY.listing(spark, tmp_dir)
    assert "binaryFile" not in found._jdf.queryExecution().toString()
    plain = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.ocr.json").load(tmp_dir)
    want = plain.select("path", "length", "_metadata.file_path").collect()
    assert {tuple(r) for r in found.collect()} == {(r[0], r[1]) for r in want} and len(want) == 3
    scan = LY.scan_layouts(spark, tmp_dir)
    assert {r["file"] for r in scan.layouts.select("file").unionByName(scan.rejects.select("file")).collect()} == {r[2] for r in want}


def test_scan_reads_what_sparks_reader_reads(spark, tmp_dir):
    texts = {"arr": f"[{GOOD % ('1', 'a')}, {GOOD % ('2', 'b')}]", "some": '[null, {"status": "running"}]', "part": f"[{GOOD % ('1', 'a')}, 7]", "none": "[]", "blank": " \n",
             "bom": "﻿" + GOOD % ("bom", ""), "null": "null", "kind": '{"status": 5, "analyzeResult": "no"}', "after": GOOD % ("t", "") + " {", "field": '{"_corrupt_record": "z", "status": "succeeded"}'}
    os.makedirs(f"{tmp_dir}/m")
    for name, data in [(k, t.encode()) for k, t in texts.items()] + [("wide", (GOOD % ("ü", "")).encode("utf-16")), ("bytes", b'{"status": "\xff"}')]:
        with open(f"{tmp_dir}/m/{name}.ocr.json", "wb") as f:
            f.write(data)
    plain = (spark.read.schema(LY.with_corrupt(LY.LAYOUT_SCHEMA)).option("multiLine", True).option("recursiveFileLookup", True)
             .option("columnNameOfCorruptRecord", LY.CORRUPT).json(tmp_dir).withColumn("file", F.col("_metadata.file_path")))
    got = LY.parsed_files(LY.listing(spark, tmp_dir), LY.LAYOUT_SCHEMA)
    assert got.columns == plain.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_stream_reads_lists_and_takes_so_many_files_a_batch(spark, tmp_dir):
    src, sink, ck = (f"{tmp_dir}/{x}" for x in ("in", "sink", "ck"))
    LY.write_layouts(bodies(spark, [(f"m/{k}", GOOD % (k, k)) for k in range(7)]), src)
    assert S.ingest_layouts(spark, src, sink, ck, max_files_per_trigger=3) == 7
    sizes = [S.ingested(spark, sink)[0].filter(F.col("batch") == b).count() for b in S.batches(spark, sink)]
    assert sizes == [3, 3, 1]
    sources = "".join(open(f"{d}/{f}").read() for d, _, fs in os.walk(ck) for f in fs if "/sources/" in d and not f.startswith("."))
    assert sources and LY.SUFFIX not in sources  # the stream's own record, held by the driver, names no layout file
    LY.write_layouts(bodies(spark, [("m/9", "[" + GOOD % ("x", "x") + "]")]), src)
    assert S.ingest_layouts(spark, src, sink, ck, max_files_per_trigger=3) == 1
    assert S.batches(spark, sink) == [0, 1, 2, 3]

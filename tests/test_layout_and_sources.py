"""Layout operators on hand-written layout JSON; file sources and sinks."""

import os

import pytest
from pyspark.sql import functions as F

from quire.operators import layout as L
from quire.sources import files as FS

FIX = os.path.join(os.path.dirname(__file__), "fixtures")


@pytest.fixture(scope="module")
def layout(spark):
    return FS.read_layout(spark, f"{FIX}/layout", L.LAYOUT_SCHEMA)


def test_read_layout_one_row_per_file(layout):
    files = sorted(os.path.basename(r.file) for r in layout.select("file").collect())
    assert files == ["invoice_2.png.ocr.json", "memo_1.png.ocr.json"]


def test_headings_pages_words_lines(layout):
    h = L.section_headings(layout).collect()
    assert [(r.pos, r.content) for r in h] == [(1, "Budget review")]
    assert L.pages(layout).count() == 2
    assert L.words(layout).count() == 8
    assert L.lines(layout).count() == 4
    assert all(r.span_ok for r in L.word_span_check(layout).collect())


def test_missing_role_is_null_and_empty_tables(layout):
    roles = {(os.path.basename(r.file), r.pos): r.role for r in L.paragraphs(layout).collect()}
    assert roles[("memo_1.png.ocr.json", 2)] is None
    assert roles[("invoice_2.png.ocr.json", 0)] is None
    cells = L.table_cells(layout)
    assert cells.count() == 3  # the invoice has an empty table list


def test_figures_resolve_paragraph_refs(layout):
    f = L.figures(layout).collect()
    assert [(r.id, r.element, r.paragraph) for r in f] == [("1.1", "/paragraphs/1", "Budget review")]


def test_table_grid_and_spans(layout):
    cells = L.table_cells(layout)
    hdr = cells.filter(F.col("kind") == "columnHeader").collect()[0]
    assert (hdr.columnSpan, hdr.rowSpan) == (2, 1)
    grid = {r.rowIndex: (r.cells.get(0), r.cells.get(1)) for r in L.table_grid(cells).collect()}
    assert grid == {0: ("Totals", None), 1: ("a", "b")}


def test_document_content_default_format(layout):
    fmt = {os.path.basename(r.file): r.format for r in L.document_content(layout).collect()}
    assert fmt == {"memo_1.png.ocr.json": "text", "invoice_2.png.ocr.json": "text"}


def test_file_lists_class_from_file_stem(spark):
    fl = FS.read_file_lists(spark, f"{FIX}/lists").collect()
    assert sorted((r["class"], r.file) for r in fl) == [
        ("file folder", "file folder/file folder_0.png"), ("memo", "memo/memo_1.png"), ("memo", "memo/memo_2.png")]


def test_write_file_lists_min_docs(spark, tmp_dir):
    pairs = spark.createDataFrame([("memo", f"memo/m{i}.png") for i in range(5)] + [("form", "form/f.png")],
                                  "class string, path string")
    FS.write_file_lists(pairs, "class", "path", f"{tmp_dir}/lists", min_docs=5)
    back = FS.read_written_file_lists(spark, f"{tmp_dir}/lists")
    assert sorted(map(tuple, back.collect())) == [("memo", f"memo/m{i}.png") for i in range(5)]
    assert back.filter(F.col("class") == "memo").count() == 5


def test_manifest_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("train/a/a_0.png", "a", "train"), ("test/a/a_0.png", "a", "test")],
                               "location string, label string, set string")
    FS.write_manifest(df, f"{tmp_dir}/manifest.csv")
    back = FS.read_manifest(spark, f"{tmp_dir}/manifest.csv")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("fmt,suffix", [("csv", ".csv"), ("parquet", ".parquet"), ("json", ".json"), ("orc", ".orc")])
def test_save_and_load_by_suffix(spark, tmp_dir, fmt, suffix):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    path = f"{tmp_dir}/t{suffix}"
    FS.save_table(df, path, fmt)
    back = FS.load_table(spark, path)
    assert sorted((int(r.k), r.v) for r in back.collect()) == [(1, "x"), (2, "y")]


def test_unknown_format_rejected(spark, tmp_dir):
    df = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        FS.save_table(df, f"{tmp_dir}/t.xlsx", "excel")
    with pytest.raises(ValueError):
        FS.load_table(spark, f"{tmp_dir}/t.xlsx")


def test_binary_scan_extension_filter_and_metadata(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/docs/sub", exist_ok=True)
    for name, data in [("a.PNG", b"\x89PNG"), ("sub/b.jpeg", b"\xff\xd8"), ("c.txt", b"no"), ("sub/d.pdf", b"%PDF")]:
        with open(f"{tmp_dir}/docs/{name}", "wb") as fh:
            fh.write(data)
    docs = FS.read_documents(spark, f"{tmp_dir}/docs")
    assert sorted(os.path.basename(r.path) for r in docs.select("path").collect()) == ["a.PNG", "b.jpeg"]
    meta = FS.format_metadata(FS.file_metadata(spark, f"{tmp_dir}/docs"))
    rows = {r.name: r for r in meta.collect()}
    assert rows["a.PNG"].content_type == "image/png" and rows["d.pdf"].content_type == "application/pdf"
    assert rows["b.jpeg"].size == 2 and "T" in rows["b.jpeg"].last_modified
    plan = FS.file_metadata(spark, f"{tmp_dir}/docs")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_as_documents_wrap(layout):
    docs = {os.path.basename(r.file): r for r in L.as_documents(layout).collect()}
    assert docs["invoice_2.png.ocr.json"].page_content == "Invoice 17"
    assert docs["memo_1.png.ocr.json"].metadata == {}


def test_checkpoint_dir_comes_from_the_session(spark):
    from quire.session import checkpoint_dir, cut_lineage

    configured = spark.conf.get("spark.checkpoint.dir")
    d = checkpoint_dir(spark)
    assert configured.rstrip("/").split("/")[-1] in d
    t = cut_lineage(spark.range(5), "unit")
    assert t.count() == 5 and configured.rstrip("/").split("/")[-1] in t.inputFiles()[0]


def test_manifest_partitioned_by_set(spark, tmp_dir):
    df = spark.createDataFrame([("train/a/a_0.png", "a", "train"), ("test/a/a_0.png", "a", "test"),
                                ("test/b/b_0.png", "b", "test")], "location string, label string, set string")
    FS.write_manifest(df, f"{tmp_dir}/m", partition_by_set=True)
    back = spark.read.option("header", True).csv(f"{tmp_dir}/m")
    assert sorted((r.location, r.label, r.set) for r in back.collect()) == sorted(map(tuple, df.collect()))
    assert back.filter(F.col("set") == "test").count() == 2  # partition pruning on set


def test_table_grid_keeps_every_column(spark):
    cells = spark.createDataFrame([("f", 0, 1, j, f"v{j}") for j in reversed(range(20))] + [("f", 0, 2, None, "loose")],
                                  "file string, table int, rowIndex long, columnIndex long, content string")
    grid = {r.rowIndex: r.cells for r in L.table_grid(cells).collect()}
    assert grid == {1: {j: f"v{j}" for j in range(20)}, 2: {-1: "loose"}}
    assert L.table_row_texts(cells).filter("rowIndex = 1").first().text == " | ".join(f"v{j}" for j in range(20))


def test_odd_file_names(spark, tmp_dir):
    import os

    for name in ("a#b.PNG", "c?d.png", "e f.png", "g+h.png", "i.txt"):
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(b"x")
    got = sorted(os.path.basename(r.path) for r in FS.read_documents(spark, tmp_dir, (".png",)).collect())
    assert len(got) == 4 and got[0].startswith("a") and "#b.PNG" in got[0]
    with open(os.path.join(tmp_dir, "a+b c.jsonl"), "w") as f:
        f.write('{"file": "x/y.png"}\n')
    assert [(r["class"], r.file) for r in FS.read_file_lists(spark, tmp_dir).collect()] == [("a+b c", "x/y.png")]


def test_line_items_are_dealt_out_by_rows(spark, tmp_dir, monkeypatch):
    from quire.plans import layout_text as LT

    li = spark.range(100).selectExpr("id % 30 AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "cast(id % 7 AS int) AS l_linenumber",
                                     "cast(1 AS double) AS l_quantity", "'N' AS l_returnflag", "'O' AS l_linestatus", "cast(2 AS double) AS l_extendedprice")
    li.write.parquet(f"{tmp_dir}/lineitem.parquet")
    monkeypatch.setattr(LT, "CELL_ROWS", 10)
    assert LT._cells(spark, tmp_dir).rdd.getNumPartitions() == 10
    got = LT.table_grid_rows(spark, tmp_dir).collect()
    assert len(got) == 100 and {r.n_cells for r in got} == {6}

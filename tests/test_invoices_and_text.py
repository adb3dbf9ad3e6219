"""Invoice validation edge cases and text helpers with awkward input."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import text as X
from quire.functions import urls as U
from quire.operators import invoices as I


def inv(spark, rows):
    return spark.createDataFrame(rows, I.INVOICE)


def test_total_check_strict_and_lenient(spark):
    rows = [([("a", 0.1, 3), ("b", 0.2, 1)], 0.5, "R1", "s", "o", "d", None),   # 0.1*3+0.2 = 0.5 exactly in decimal
            ([("a", 10.0, 1)], 11.0, "R2", "s", "o", "d", "x"),
            ([], 0.0, "R3", "s", "o", "d", None)]                                # item-less invoice
    good, rej = I.total_check(inv(spark, rows), strict=True)
    assert sorted(r.reference_number for r in good.collect()) == ["R1", "R3"]
    assert [(r.reference_number, r.reason) for r in rej.collect()] == [("R2", "total mismatch")]
    allrows, none = I.total_check(inv(spark, rows), strict=False)
    warn = {r.reference_number: r.warning for r in allrows.collect()}
    assert warn == {"R1": None, "R2": "total mismatch", "R3": None} and none.count() == 0


def test_missing_reference_no_trim(spark):
    rows = [([], 1.0, "", "s", "o", "d", None), ([], 1.0, " ", "s", "o", "d", None),
            ([], 1.0, "R9", "s", "o", "d", None)]
    df = spark.createDataFrame(rows, I.INVOICE)
    ok, rej = I.missing_reference(df)
    assert sorted(r.reference_number for r in ok.collect()) == [" ", "R9"]  # whitespace is truthy
    assert rej.count() == 1


def test_index_record_formats_like_python(spark):
    rows = [([("pen", 901.0, 2), ("ink", 1234.56, 1), ("gold", 10000000.0, 1)], 1.0, "R1", "s", "o", "d", None),
            ([], 0.0, "R2", "s", "o", "d", "sum")]
    rec = {r.id: r for r in I.index_record(inv(spark, rows)).collect()}
    assert [x.list_item for x in rec["R1"].items_purchased] == [
        f"pen, {901.0}, 2", f"ink, {1234.56}, 1", f"gold, {10000000.0}, 1"]
    assert rec["R2"].items_purchased == [] and rec["R2"].content_vector == [] and rec["R1"].content is None


def test_parse_invoices_rejects_bad_json_and_missing_fields(spark):
    good_js = '{"items":[{"name":"a","price":1.5,"quantity":2}],"total":3.0,"reference_number":"R",' \
              '"signature_on_document":"s","origin_address":"o","destination_address":"d"}'
    rows = [(1, good_js), (2, "{not json"), (3, '{"items":[],"total":1.0}')]
    df = spark.createDataFrame(rows, "id int, js string")
    good, rej = I.parse_invoices(F.col("js"), df)
    assert [r.id for r in good.collect()] == [1]
    assert sorted(r.id for r in rej.collect()) == [2, 3]
    assert good.collect()[0].invoice.items[0].quantity == 2


def test_render_and_snippet_with_awkward_text(spark):
    txt = 'Total: 50% off "today"\nline two {x} %s'
    df = spark.createDataFrame([(txt,)], "t string")
    r = df.select(X.render("HEAD ", "t", " TAIL").alias("p"), X.snippet("t", 12).alias("s"),
                  X.clean_label(F.lit(' "news article" ')).alias("c")).collect()[0]
    assert r.p == "HEAD " + txt + " TAIL"
    assert r.s == "Total: 50% o" and r.c == "newsarticle"


def test_url_helpers(spark):
    df = spark.createDataFrame([("https://acct.example.net/cont/a/b c.PNG?x=1#f",), ("local/dir/file.pdf",),
                                ("http://h/only",)], "u string")
    c, b = U.container_and_blob("u")
    rows = df.select(c.alias("c"), b.alias("b"), U.extension("u").alias("e"), U.basename("u").alias("n"),
                     U.route("u", "example.net").alias("r")).collect()
    assert [(r.c, r.b, r.e, r.n, r.r) for r in rows] == [
        ("cont", "a/b c.PNG", ".png", "b c.PNG", "object"),
        ("local", "dir/file.pdf", ".pdf", "file.pdf", "local"),
        ("only", "", "", "only", "error")]


def test_strip_spaces_reaches_maps_arrays_and_structs(spark):
    df = spark.createDataFrame(
        [({"k 1": "a b"}, ["c d", None], ("e f", 3))],
        "m map<string,string>, a array<string>, s struct<x:string,n:int>")
    r = X.strip_spaces_df(df).collect()[0]
    assert r.m == {"k 1": "ab"} and r.a == ["cd", None] and (r.s.x, r.s.n) == ("ef", 3)


def test_arrow_token_counter_hook(spark):
    from quire.operators import tokens as TK

    count = TK.arrow_counter(lambda s: s.split())
    df = spark.createDataFrame([("a b  c",), (None,), ("",)], "t string")
    assert [r.n for r in df.select(count("t").alias("n")).collect()] == [3, 0, 0]


def test_content_parts_order(spark):
    from quire.operators import conversations as M

    df = spark.createDataFrame([("hi", ["u1", "u2"])], "t string, urls array<string>")
    chat = df.select(M.content_parts(F.col("t"), F.col("urls")).alias("p")).first().p
    slm = df.select(M.content_parts(F.col("t"), F.col("urls"), image_first=True).alias("p")).first().p
    assert [x.type for x in chat] == ["text", "image_url", "image_url"]
    assert [x.type for x in slm] == ["image_url", "image_url", "text"] and slm[0].url == "u1"


def test_index_record_json_string_form(spark):
    import json

    rows = [([("pen", 10000000.0, 1)], 1.0, "R1", "s", "o", "d", None)]
    js = I.index_record_json(inv(spark, rows)).collect()[0]
    rec = json.loads(js.json)
    assert js.id == "R1" and rec["content"] == "" and rec["content_vector"] == []
    assert rec["items_purchased"] == [{"list_item": "pen, 10000000.0, 1"}]


def test_totals_keep_parts_of_a_cent(spark):
    rows = [("a", [("x", 0.333, 3)], 0.999), ("b", [("x", 0.005, 100)], 0.5), ("c", [("x", 0.1, 3), ("y", 0.2, 1)], 0.5),
            ("d", [("x", 0.333, 3)], 1.0), ("e", [("x", 0.123456789012345, 1)], 0.123456789012345), ("f", [("x", 0.333, 3)], 0.99)]
    df = spark.createDataFrame(rows, "reference_number string, items array<struct<name:string,price:double,quantity:int>>, total double")
    good, rej = I.total_check(df)
    assert sorted(r.reference_number for r in good.collect()) == ["a", "b", "c", "d", "e"]
    assert [r.reference_number for r in rej.collect()] == ["f"]


def test_price_text_is_the_shortest(spark):
    values = [901.0, 1234.56, 0.1, 0.123456789012345, 1e-11, 0.00012, 1e7, 123456789.25, 1e15, 1.5e16, 1e22, 0.0, 0.001, 5e-5, -2.5e-7, -1e8]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", I.py_float_str(F.col("v")).alias("s"))
    assert [r.s for r in got.orderBy("i").collect()] == [repr(v) for v in values]


def test_parse_names_every_broken_rule(spark):
    import json

    whole = {"items": [{"name": "n", "price": 1.5, "quantity": 2}], "total": 3.0, "reference_number": "R", "signature_on_document": "s",
             "origin_address": "o", "destination_address": "d", "summary": None}
    cases = {"ok": whole, "empty": whole | {"items": []}, "none": {k: v for k, v in whole.items() if k != "items"},
             "nulls": whole | {"items": [{"name": None, "price": None, "quantity": None}]},
             "type": whole | {"total": "nine"}, "two": whole | {"reference_number": None, "items": [{"name": "n", "price": 1.0}]}}
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in cases.items()] + [("text", "no json")], "k string, js string")
    good, rej = I.parse_invoices(F.col("js"), df)
    assert sorted(r.k for r in good.collect()) == ["empty", "ok"]
    assert {r.k: r.reason for r in rej.collect()} == {"none": "missing:items", "nulls": "item:name;item:price;item:quantity", "type": "unparsable",
                                                      "text": "unparsable", "two": "missing:reference_number;item:quantity"}

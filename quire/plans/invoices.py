"""Invoice queries on ``orders ⋈ lineitem ⋈ part`` (+ customer, nation, region).

Each order is one invoice: items are its line items (part name, retail
price, quantity); the signer is the customer, origin / destination are the
customer's nation / region. Fulfilled orders (status 'F') carry the total of
their items, others the order's own total price, so the total check sees
both outcomes; pending orders ('P') have no reference number yet.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import text as X
from quire.operators import invoices as I
from quire.operators.retrieval import HASH_DIM
from quire.plans.common import spread, sql_hashed_embedding
from quire.plans.registry import register
from quire.sources.tables import Tables

SORT = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]

_INV_SQL = """
items AS (
  SELECT l_orderkey,
         list(struct_pack(name := p_name, price := p_retailprice, quantity := CAST(l_quantity AS INTEGER))
              ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS items,
         sum(CAST(CAST(p_retailprice AS VARCHAR) AS DECIMAL(26,15)) * CAST(l_quantity AS INTEGER)) AS items_total
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
inv AS (
  SELECT o_orderkey, coalesce(items, []) AS items,
         CASE WHEN o_orderstatus = 'F' THEN CAST(coalesce(items_total, 0) AS DOUBLE) ELSE o_totalprice END AS total,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'INV-' || CAST(o_orderkey AS VARCHAR) END AS reference_number,
         c_name AS signature_on_document, n_name AS origin_address, r_name AS destination_address,
         'Invoice ' || CAST(o_orderkey AS VARCHAR) || ' for ' || c_name || ' dated ' || strftime(o_orderdate, '%Y-%m-%d') AS summary
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey LEFT JOIN items ON o_orderkey = l_orderkey)
"""
_SQL_PYFLOAT = "CAST({x} AS VARCHAR)"  # shortest digits


def invoices(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = spread(t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"))
    lp = li.join(t.part.select("p_partkey", "p_name", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    items = I.items_per_key(lp, "l_orderkey", SORT, F.col("p_name"), F.col("p_retailprice"), F.col("l_quantity"))
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
         .join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left"))
    return j.select(
        "o_orderkey",
        F.coalesce("items", F.array().cast(T.ArrayType(I.ITEM))).alias("items"),
        F.when(F.col("o_orderstatus") == "F", F.coalesce("items_total", F.lit(0)).cast("double"))
        .otherwise(F.col("o_totalprice")).alias("total"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("INV-"), F.col("o_orderkey").cast("string"))).alias("reference_number"),
        F.col("c_name").alias("signature_on_document"),
        F.col("n_name").alias("origin_address"),
        F.col("r_name").alias("destination_address"),
        F.concat(F.lit("Invoice "), F.col("o_orderkey").cast("string"), F.lit(" for "), F.col("c_name"),
                 F.lit(" dated "), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("summary"),
    )


@register("invoice_assemble", oracle=f"""
WITH {_INV_SQL}
SELECT o_orderkey, CAST(len(items) AS INTEGER) AS n_items, to_json(items)::VARCHAR AS items_json, total, reference_number,
       signature_on_document, origin_address, destination_address, summary
FROM inv
""")
def invoice_assemble(spark, sf_dir):
    inv = invoices(spark, sf_dir)
    return inv.select("o_orderkey", F.size("items").alias("n_items"), F.to_json("items").alias("items_json"),
                      "total", "reference_number", "signature_on_document", "origin_address",
                      "destination_address", "summary")


@register("invoice_total_check", oracle=f"""
WITH {_INV_SQL},
c AS (SELECT o_orderkey, total,
             coalesce((SELECT sum(CAST(CAST(CASE WHEN o_orderkey % 13 = 0 THEN round(x.price / 1000, 5) ELSE x.price END AS VARCHAR) AS DECIMAL(26,15))
                                  * x.quantity) FROM (SELECT unnest(items) AS x)), 0) AS calc
      FROM inv)
SELECT o_orderkey, CAST(calc AS DOUBLE) AS calculated_total, total,
       coalesce(calc = CAST(CAST(total AS VARCHAR) AS DECIMAL(37,15)) OR round(calc, 2) = CAST(CAST(total AS VARCHAR) AS DECIMAL(37,15)), false) AS total_matches
FROM c
""")
def invoice_total_check(spark, sf_dir):
    """Every thirteenth invoice states its prices in thousandths, so prices below a cent take part."""
    inv = invoices(spark, sf_dir)
    small = F.transform("items", lambda i: i.withField("price", F.round(i["price"] / 1000, 5)))
    inv = inv.withColumn("items", F.when(F.col("o_orderkey") % 13 == 0, small).otherwise(F.col("items")))
    good, rej = I.total_check(inv, strict=True, keep=["o_orderkey", "total"])
    cols = ["o_orderkey", "calculated_total", "total", "total_matches"]
    return good.select(*cols).unionByName(rej.select(*cols))


@register("invoice_missing_ref", oracle=f"""
WITH {_INV_SQL}
SELECT o_orderkey, 'no_reference_number' AS reason FROM inv WHERE coalesce(reference_number = '', true)
""")
def invoice_missing_ref(spark, sf_dir):
    _, rej = I.missing_reference(invoices(spark, sf_dir))
    return rej.select("o_orderkey", "reason")


@register("invoice_parse", oracle=f"""
WITH {_INV_SQL},
k AS (SELECT o_orderkey, o_orderkey % 11 AS kind, len(items) AS n, reference_number IS NULL AS noref FROM inv)
SELECT o_orderkey, CASE WHEN kind = 3 THEN 'unparsable'
                        ELSE nullif(concat_ws(';', CASE WHEN kind = 1 THEN 'missing:items' END,
                                                   CASE WHEN noref THEN 'missing:reference_number' END,
                                                   CASE WHEN kind = 2 AND n > 0 THEN 'item:name' END), '') END AS reason
FROM k
""")
def invoice_parse(spark, sf_dir):
    """Model output as a model might give it: every eleventh invoice has no items, has an
    item without a name, or states its total as a word."""
    inv = invoices(spark, sf_dir)
    kind = F.col("o_orderkey") % 11
    nameless = F.transform("items", lambda x, k: F.when(k == 0, x.withField("name", F.lit(None).cast("string"))).otherwise(x))
    inv = inv.withColumn("items", F.when(kind == 1, F.lit(None)).when(kind == 2, nameless).otherwise(F.col("items")))
    whole = F.to_json(F.struct(*[c for c in inv.columns if c != "o_orderkey"]))
    worded = F.regexp_replace(whole, r'"total":[0-9.Ee+-]+', '"total":"nine hundred"')
    js = inv.select("o_orderkey", F.when(kind == 3, worded).otherwise(whole).alias("js"))
    good, rej = I.parse_invoices(F.col("js"), js)
    return good.select("o_orderkey", F.lit(None).cast("string").alias("reason")).unionByName(rej.select("o_orderkey", "reason"))


_FIELD_SRC = {
    "CustomerName": "c_name", "CustomerId": "CAST(o_custkey AS VARCHAR)",
    "InvoiceId": "CAST(o_orderkey AS VARCHAR)", "InvoiceDate": "strftime(o_orderdate, '%Y-%m-%d')",
    "InvoiceTotal": "CAST(o_totalprice AS VARCHAR)",
}


def _field_cols_sql():
    out = []
    for f in I.INVOICE_FIELDS:
        if f in _FIELD_SRC:
            out.append(f"{_FIELD_SRC[f]} AS {f}_content, CAST(0.95 AS DOUBLE) AS {f}_confidence")
        else:
            out.append(f"NULL::VARCHAR AS {f}_content, NULL::DOUBLE AS {f}_confidence")
    return ", ".join(out)


@register("invoice_fields", oracle=f"""
SELECT o_orderkey, {_field_cols_sql()} FROM orders JOIN customer ON o_custkey = c_custkey
""")
def invoice_fields(spark, sf_dir):
    t = Tables(spark, sf_dir)
    oc = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    conf = F.lit(0.95)
    src = {
        "CustomerName": F.col("c_name"), "CustomerId": F.col("o_custkey").cast("string"),
        "InvoiceId": F.col("o_orderkey").cast("string"), "InvoiceDate": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "InvoiceTotal": F.col("o_totalprice").cast("string"),
    }
    fields = F.create_map(*[x for k, v in src.items()
                            for x in (F.lit(k), F.struct(v.alias("content"), conf.alias("confidence")))])
    doc = oc.select("o_orderkey", fields.alias("fields"))
    hf = doc.select("o_orderkey", *I.header_fields(F.col("fields")))
    return hf.select("o_orderkey", *[c for f in I.INVOICE_FIELDS for c in (
        F.col(f"{f}.content").alias(f"{f}_content"), F.col(f"{f}.confidence").alias(f"{f}_confidence"))])


@register("invoice_items", oracle="""
WITH li AS (
  SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS pos,
         p_name, l_quantity, p_retailprice, l_partkey, l_extendedprice
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_orderkey AS o_orderkey, CAST(pos AS INTEGER) AS pos, p_name AS Description,
       CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS Quantity, NULL::VARCHAR AS Unit,
       CAST(p_retailprice AS VARCHAR) AS UnitPrice, CAST(l_partkey AS VARCHAR) AS ProductCode,
       NULL::VARCHAR AS Date, NULL::VARCHAR AS Tax, CAST(l_extendedprice AS VARCHAR) AS Amount
FROM li
""")
def invoice_items(spark, sf_dir):
    """E8 in long form: each line item's analyzer object projected to the 8 item
    fields, positioned inside its invoice by ``bucketed_rank`` over line-number
    ranges — no invoice is gathered into one task."""
    from quire.operators.sampling import bucketed_rank

    t = Tables(spark, sf_dir)
    lp = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    f = lambda v: F.struct(v.cast("string").alias("content"), F.lit(0.9).alias("confidence"))
    obj = F.create_map(F.lit("Description"), f(F.col("p_name")),
                       F.lit("Quantity"), f(F.col("l_quantity").cast("int")),
                       F.lit("UnitPrice"), f(F.col("p_retailprice")),
                       F.lit("ProductCode"), f(F.col("l_partkey")),
                       F.lit("Amount"), f(F.col("l_extendedprice")))
    rows = lp.select(F.col("l_orderkey").alias("o_orderkey"), *SORT, I.item_fields(obj).alias("it"))
    ranked = bucketed_rank(rows, ["o_orderkey"], [F.col(c) for c in SORT],
                           F.floor(F.col("l_linenumber") / F.lit(1024)), out="_p")
    return ranked.select("o_orderkey", F.col("_p").cast("int").alias("pos"),
                         *[F.col(f"it.{n}.content").alias(n) for n in I.ITEM_FIELDS])


@register("invoice_index_record", bench=True, oracle=f"""
WITH {_INV_SQL},
ip AS (SELECT o_orderkey, list_transform(items, lambda x: struct_pack(list_item := x.name || ', ' || ({_SQL_PYFLOAT.format(x='x.price')}) || ', ' || CAST(x.quantity AS VARCHAR))) AS items_purchased
       FROM inv)
SELECT reference_number AS id, summary AS content, '[]' AS content_vector, total, reference_number,
       signature_on_document, origin_address, destination_address,
       coalesce(to_json(ip.items_purchased)::VARCHAR, '[]') AS items_purchased
FROM inv LEFT JOIN ip USING (o_orderkey)
""")
def invoice_index_record(spark, sf_dir):
    rec = I.index_record(invoices(spark, sf_dir))
    return rec.withColumn("content_vector", F.to_json("content_vector")).withColumn(
        "items_purchased", F.to_json("items_purchased"))


@register("strip_spaces_nested", oracle=f"""
WITH {_INV_SQL}
SELECT o_orderkey,
       to_json(list_transform(items, lambda x: struct_pack(name := replace(x.name, ' ', ''), price := x.price,
                                                           quantity := x.quantity)))::VARCHAR AS items_json,
       replace(signature_on_document, ' ', '') AS signature_on_document,
       replace(summary, ' ', '') AS summary
FROM inv
""")
def strip_spaces_nested(spark, sf_dir):
    """P8 on the typed invoice: every string leaf (item names included) loses its spaces."""
    inv = X.strip_spaces_df(invoices(spark, sf_dir).select("o_orderkey", "items", "signature_on_document",
                                                           "summary"))
    return inv.select("o_orderkey", F.to_json("items").alias("items_json"), "signature_on_document", "summary")


@register("embed_first_five", oracle=f"""
WITH {_INV_SQL},
first5 AS (SELECT reference_number AS id, summary AS content FROM inv WHERE reference_number IS NOT NULL
           ORDER BY reference_number LIMIT 5)
""" + sql_hashed_embedding("first5", "id", "content", HASH_DIM).replace("embedding", "content_vector"))
def embed_first_five(spark, sf_dir):
    """K7 + E14: the first five index records (by id) get a content vector."""
    from quire.operators.retrieval import hashed_embedding

    rec = I.index_record(invoices(spark, sf_dir)).filter(F.col("id").isNotNull())
    first = rec.orderBy("id").limit(5)
    return first.select("id", hashed_embedding("content").alias("content_vector"))


INVOICE_DIM = 1536  # width of the searchable index's vector field
_INVOICE_VECS = f"""
WITH {_INV_SQL},
rec AS (SELECT reference_number AS id, summary AS content FROM inv WHERE reference_number IS NOT NULL)
"""


@register("embed_invoices", oracle=_INVOICE_VECS + f"""
, e AS ({sql_hashed_embedding("rec", "id", "content", INVOICE_DIM)})
SELECT id, CAST(len(embedding) AS INTEGER) AS dim, len(list_filter(embedding, lambda x: x > 0)) AS n_used,
       round(list_sum(list_transform(embedding, lambda x: x * x)), 6) AS norm2 FROM e
""")
def embed_invoices(spark, sf_dir):
    """E14 on every index record: 1536 floats each."""
    from quire.operators.retrieval import vector_stats

    v = _invoice_vectors(spark, sf_dir).select("id", vector_stats("content_vector").alias("s"))
    return v.select("id", "s.dim", "s.n_used", F.round("s.norm2", 6).alias("norm2"))


#: Records that a task embeds, about: a record takes few bytes before it is a vector, and a
#: vector few in a file, so tasks and files are made by rows.
EMBED_ROWS = 100_000


def _invoice_records(spark, sf_dir):
    rec = I.index_record(invoices(spark, sf_dir)).filter(F.col("id").isNotNull()).select("id", "content")
    tasks = max(spark.sparkContext.defaultParallelism, -(-Tables(spark, sf_dir).orders.count() // EMBED_ROWS))
    return rec.repartition(tasks)


def _embedded(rec):
    from quire.operators.retrieval import hashed_embedding

    return rec.select("id", hashed_embedding("content", INVOICE_DIM).alias("content_vector"))


def _invoice_vectors(spark, sf_dir):
    return _embedded(_invoice_records(spark, sf_dir))


@register("invoice_vector_search", oracle=_INVOICE_VECS + """
, tok AS (SELECT id, unnest(list_filter(string_split_regex(lower(content), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS t FROM rec),
b AS MATERIALIZED (SELECT id, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % 1536 AS b, count(*) AS c FROM tok GROUP BY 1, 2),
n AS MATERIALIZED (SELECT id, sqrt(sum(c * c)) AS n FROM b GROUP BY id),
qb AS MATERIALIZED (SELECT id, b, c FROM b WHERE CAST(substr(id, 5) AS BIGINT) % 100 = 0),
dot AS MATERIALIZED (SELECT q.id AS qid, v.id AS vid, sum(q.c * v.c) AS d FROM qb q JOIN b v ON q.b = v.b GROUP BY q.id, v.id),
s AS (SELECT qid, vid, round(d / (qn.n * vn.n), 8) AS score FROM dot JOIN n qn ON qn.id = qid JOIN n vn ON vn.id = vid)
SELECT qid, CAST(rank AS INTEGER) AS rank, vid, score
FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vid) AS rank FROM s) WHERE rank <= 3
""")
def invoice_vector_search(spark, sf_dir):
    """R2 over the invoice index with its string keys; the queries are the records whose
    order number is divisible by 100."""
    from quire.operators.retrieval import vector_search
    from quire.session import cut_lineage

    v = _embedded(cut_lineage(_invoice_records(spark, sf_dir), "invoice-records"))  # a record is far smaller than its vector
    q = v.filter(F.substring("id", 5, 20).cast("long") % 100 == 0).select(F.col("id").alias("q"), F.col("content_vector").alias("w"))
    return vector_search(v, "id", "content_vector", q, "q", "w", k=3)

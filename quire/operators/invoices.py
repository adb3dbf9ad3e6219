"""Invoice extraction, validation and index records.

The typed invoice is ``STRUCT<items ARRAY<STRUCT<name, price, quantity>>,
total, reference_number, signature_on_document, origin_address,
destination_address, summary>``. Validation never drops rows: each rule
splits its input into an accepted and a reject table with a reason.

Money is DOUBLE in the entity (as extracted). Sums are taken over the exact
decimal value of its shortest text (15 decimals), so a total neither depends
on the order rows arrive in nor loses part of a cent before the sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import cut_lineage

# Header fields of the prebuilt invoice analyzer, in order.
INVOICE_FIELDS = [
    "VendorName", "VendorAddress", "VendorAddressRecipient", "CustomerName", "CustomerId",
    "CustomerAddress", "CustomerAddressRecipient", "InvoiceId", "InvoiceDate", "InvoiceTotal",
    "DueDate", "PurchaseOrder", "BillingAddress", "BillingAddressRecipient", "ShippingAddress",
    "ShippingAddressRecipient", "SubTotal", "TotalTax", "PreviousUnpaidBalance", "AmountDue",
    "ServiceStartDate", "ServiceEndDate", "ServiceAddress", "ServiceAddressRecipient",
    "RemittanceAddress", "RemittanceAddressRecipient",
]
# Fields of one line item, in order.
ITEM_FIELDS = ["Description", "Quantity", "Unit", "UnitPrice", "ProductCode", "Date", "Tax", "Amount"]

FIELD = T.StructType([T.StructField("content", T.StringType()),
                      T.StructField("confidence", T.DoubleType())])
ITEM = T.StructType([T.StructField("name", T.StringType()),
                     T.StructField("price", T.DoubleType()),
                     T.StructField("quantity", T.IntegerType())])
INVOICE = T.StructType([
    T.StructField("items", T.ArrayType(ITEM)),
    T.StructField("total", T.DoubleType(), False),
    T.StructField("reference_number", T.StringType(), False),
    T.StructField("signature_on_document", T.StringType(), False),
    T.StructField("origin_address", T.StringType(), False),
    T.StructField("destination_address", T.StringType(), False),
    T.StructField("summary", T.StringType()),
])
PRICE = "decimal(26,15)"  # times an integer: decimal(37,15), exact
TOTAL = "decimal(37,15)"  # one digit short of the widest, so adding two keeps the scale


def _null_field() -> Column:
    return F.struct(F.lit(None).cast("string").alias("content"), F.lit(None).cast("double").alias("confidence"))


def header_fields(fields_map: Column, names: Sequence[str] = INVOICE_FIELDS) -> list[Column]:
    """One ``{content, confidence}`` struct per named field; a missing field is all-null."""
    return [F.coalesce(F.try_element_at(fields_map, F.lit(n)), _null_field()).alias(n) for n in names]


def item_fields(obj: Column, names: Sequence[str] = ITEM_FIELDS) -> Column:
    """One line item's ``valueObject`` map -> STRUCT of the 8 item fields (missing -> nulls)."""
    return F.struct(*[F.coalesce(F.try_element_at(obj, F.lit(n)), _null_field()).alias(n) for n in names])


def line_items(items: Column, names: Sequence[str] = ITEM_FIELDS) -> Column:
    """``Items.valueArray[].valueObject`` -> ARRAY<STRUCT<8 fields>>; missing Items -> []."""
    arr = F.coalesce(items, F.array().cast(T.ArrayType(T.MapType(T.StringType(), FIELD))))
    return F.transform(arr, lambda obj: item_fields(obj, names))


def item_struct(name: Column, price: Column, quantity: Column) -> Column:
    return F.struct(name.cast("string").alias("name"), price.cast("double").alias("price"),
                    quantity.cast("int").alias("quantity"))


def items_per_key(rows: DataFrame, key: str, sort_cols: Sequence[str], name: Column,
                  price: Column, quantity: Column) -> DataFrame:
    """(key, items, items_total): ordered item array plus Σ price*quantity in DECIMAL.

    ``sort_cols`` must order a key's rows completely (the driver data has
    duplicate line numbers). The decimal total is a partial aggregate; the
    item array is the typed invoice itself. ``invoice_items`` gives the items
    in long form where no array is wanted.
    """
    ordered = F.struct(*[F.col(c) for c in sort_cols], item_struct(name, price, quantity).alias("_it"))
    return rows.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(ordered)), lambda x: x["_it"]).alias("items"),
        F.sum(price.cast(PRICE) * quantity.cast("int")).cast(TOTAL).alias("items_total"),
    )


def items_total(items: Column) -> Column:
    """Σ price * quantity over an item array, in DECIMAL (order independent)."""
    return F.aggregate(F.coalesce(items, F.array().cast(T.ArrayType(ITEM))),
                       F.lit(0).cast(TOTAL),
                       lambda acc, i: (acc + (i["price"].cast(PRICE) * i["quantity"]).cast(TOTAL)).cast(TOTAL))


def total_check(inv: DataFrame, strict: bool = True, keep: Sequence[str] | None = None):
    """Calculated Σ price*quantity vs ``total``: equal exactly, or the sum rounded
    once to cents equals it (a total stated in cents).

    strict -> (accepted, rejects); lenient -> (all rows with ``warning``, empty rejects).
    Both tables of a strict check read ``inv``: with ``keep``, the checked rows are written once
    with these columns of it, so ``inv`` is computed once.
    """
    calc, total = items_total(F.col("items")), F.col("total").cast(TOTAL)
    ok = F.coalesce((calc == total) | (F.round(calc, 2) == total), F.lit(False))
    d = inv.withColumn("calculated_total", calc.cast("double")).withColumn("total_matches", ok)
    if keep is not None:
        d = cut_lineage(d.select(*keep, "calculated_total", "total_matches"), "checked-totals")
    if strict:
        ok = F.col("total_matches")
        rej = d.filter(~ok).withColumn("reason", F.lit("total mismatch"))
        return d.filter(ok), rej
    warn = F.when(~ok, F.lit("total mismatch"))
    return d.withColumn("warning", warn), d.limit(0).withColumn("reason", F.lit(None).cast("string"))


NO_REFERENCE = "no_reference_number"


def missing_reference(inv: DataFrame):
    """A null or empty reference number rejects the invoice (no trimming)."""
    bad = F.coalesce(F.col("reference_number") == "", F.lit(True))
    return inv.filter(~bad), inv.filter(bad).withColumn("reason", F.lit(NO_REFERENCE))


#: Fields of an invoice that must be there (a summary may be missing), in order.
REQUIRED = ["items", "total", "reference_number", "signature_on_document", "origin_address", "destination_address"]


def invoice_faults(invoice: Column) -> Column:
    """ARRAY<STRING> of reason codes: ``missing:<field>`` for each required field,
    ``item:<field>`` for an item field that some item lacks."""
    items = F.coalesce(invoice["items"], F.array().cast(T.ArrayType(ITEM)))
    tests = [(f"missing:{f}", invoice[f].isNull()) for f in REQUIRED]

    def lacks(name: str) -> Column:
        return F.exists(items, lambda i: i.isNull() | i[name].isNull())

    tests += [(f"item:{f.name}", lacks(f.name)) for f in ITEM.fields]
    return F.array_compact(F.array(*[F.when(bad, F.lit(code)) for code, bad in tests]))


def parse_invoices(json_col: Column, df: DataFrame):
    """Typed parse of model output; unparsable, wrongly typed or incomplete output
    goes to the reject table with every rule it breaks as ``reason``."""
    schema = T.StructType(INVOICE.fields + [T.StructField("_corrupt", T.StringType())])
    parsed = df.withColumn("invoice", F.from_json(json_col, schema, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    broken = F.col("invoice").isNull() | F.col("invoice._corrupt").isNotNull()
    parsed = parsed.withColumn("reason", F.when(broken, F.lit("unparsable")).otherwise(
        F.array_join(invoice_faults(F.col("invoice")), ";")))
    bad = F.col("reason") != ""
    good = parsed.filter(~bad).drop("reason").withColumn("invoice", F.col("invoice").dropFields("_corrupt"))
    return good, parsed.filter(bad)


def py_float_str(c: Column) -> Column:
    """Python-style text of a double (901.0, 1234.56, 1e-11): its shortest digits, in
    positional form from 1e-4 up to 1e16, else with an exponent of two digits."""
    s = c.cast("string")
    sign, mantissa = F.when(s.startswith("-"), F.lit("-")).otherwise(F.lit("")), F.regexp_extract(s, r"^-?([0-9.]+)E", 1)
    exponent = F.regexp_extract(s, r"E(-?[0-9]+)$", 1).try_cast("int")
    digits = F.concat(F.substring_index(mantissa, ".", 1), F.regexp_replace(F.substring_index(mantissa, ".", -1), "0+$", ""))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    whole = F.concat(F.rpad(F.substring(digits, F.lit(1), exponent + 1), exponent + 1, F.lit("0")), F.lit("."),
                     F.when(F.length(digits) > exponent + 1, F.substring(digits, exponent + 2, F.length(digits))).otherwise(F.lit("0")))
    point = F.concat(F.substring(digits, 1, 1), F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substring(digits, 2, 1 << 10))).otherwise(F.lit("")))
    science = F.concat(point, F.lit("e"), F.when(exponent < 0, F.lit("-")).otherwise(F.lit("+")), F.lpad(F.abs(exponent).cast("string"), 2, "0"))
    return F.when(~s.contains("E"), s).otherwise(F.concat(sign, F.when((exponent < 0) & (exponent >= -4), small)
                                                            .when((exponent >= 0) & (exponent < 16), whole).otherwise(science)))


def index_record(inv: DataFrame) -> DataFrame:
    """Invoice -> search-index record (id = reference number, empty vector)."""
    items = F.transform(F.coalesce(F.col("items"), F.array().cast(T.ArrayType(ITEM))), lambda i: F.struct(
        F.concat_ws(", ", i["name"], py_float_str(i["price"]), i["quantity"].cast("string")).alias("list_item")))
    return inv.select(
        F.col("reference_number").alias("id"),
        F.col("summary").alias("content"),
        F.array().cast("array<float>").alias("content_vector"),
        "total", "reference_number", "signature_on_document", "origin_address", "destination_address",
        items.alias("items_purchased"),
    )


def index_record_json(inv: DataFrame) -> DataFrame:
    """E13 string form: (id, json) where a missing summary is the empty string
    and prices keep Python's float text inside ``items_purchased``."""
    rec = index_record(inv).withColumn("content", F.coalesce(F.col("content"), F.lit("")))
    return rec.select("id", F.to_json(F.struct(*[F.col(c) for c in rec.columns])).alias("json"))

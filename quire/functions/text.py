"""Column-expression text helpers (all JVM-side, whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token rule shared with the DuckDB oracles: lower-case, split on any run of
# characters that are neither Unicode letters nor digits, drop empties.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """ARRAY<STRING> of lower-cased word tokens of the whole text (``array_remove``
    drops the empty strings around separators; no lambda, so it stays in
    generated code)."""
    return F.array_remove(F.split(F.lower(col_(text)), TOKEN_SPLIT), "")


def clean_label(c) -> Column:
    """Remove every space and double quote (label normalisation of model output)."""
    return F.translate(col_(c), ' "', "")


def snippet(c, n: int = 1000) -> Column:
    """Newlines to spaces, then the first ``n`` characters (display snippet)."""
    return F.substring(F.translate(col_(c), "\n", " "), 1, n)


def data_uri(binary_col) -> Column:
    """``data:image/jpeg;base64,<b64>``; the base64 body has no line breaks."""
    return F.concat(F.lit("data:image/jpeg;base64,"),
                    F.regexp_replace(F.base64(col_(binary_col)), r"\s", ""))


def render(template_head: str, body, template_tail: str) -> Column:
    """Prompt text = head + body + tail via concat (never format strings:
    the body may contain ``%`` or braces)."""
    return F.concat(F.lit(template_head), F.coalesce(col_(body), F.lit("")), F.lit(template_tail))


def strip_spaces(c: Column, dtype) -> Column:
    """Remove every space from every string value at any depth.

    Typed recursion over the schema: structs rebuild their fields, arrays
    ``transform``, maps ``transform_values`` (keys untouched). No JSON
    round trip, no Python.
    """
    from pyspark.sql import types as T

    if isinstance(dtype, T.StringType):
        return F.translate(c, " ", "")
    if isinstance(dtype, T.StructType):
        return F.when(c.isNull(), F.lit(None)).otherwise(F.struct(*[
            strip_spaces(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: strip_spaces(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(c, lambda k, v: strip_spaces(v, dtype.valueType))
    return c


def strip_spaces_df(df):
    """P8 over every column of a DataFrame."""
    return df.select(*[strip_spaces(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])

"""Upsert and field-unwrap queries over ``events`` and ``customer``.

Events are index updates keyed by ``user_id`` and ordered by
``(ts, event_id)``. The collection is first loaded with the events before
``CUTOFF`` and then merged with the rest; last-wins makes the final state
independent of where the cut lies.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.plans.registry import register
from quire.sources import upsert as U
from quire.sources.tables import Tables

CUTOFF = "2024-01-15 00:00:00"
COLS = ["user_id", "event_id", "ts", "event_type", "value"]
OUT = ["id"] + COLS
SEQ = ["ts", "event_id"]
LAST_WINS_SQL = """
SELECT CAST(user_id AS VARCHAR) AS id, user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE user_id IS NOT NULL)
WHERE rn = 1
"""


@register("upsert_last_wins", bench=True, oracle=LAST_WINS_SQL)
def upsert_last_wins(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select(*COLS)
    early = ev.filter(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))
    late = ev.filter(F.col("ts") >= F.lit(CUTOFF).cast("timestamp_ntz"))
    target = U.latest_per_key(early.filter(U.valid_key("user_id")), "user_id", SEQ)
    merged = U.merge(target, late, "user_id", SEQ)
    # the stored item carries its key as the string ``id``
    return merged.select(F.col("user_id").cast("string").alias("id"), *COLS)


@register("unwrap_fields", oracle="""
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_acctbal
FROM customer
""")
def unwrap_fields(spark, sf_dir):
    """Customer rows as an analyzer would return them: fields wrapped in
    ``{content, confidence}``; a segment reads the literal "null" for
    customers in debt."""
    c = Tables(spark, sf_dir).customer
    wrap = lambda v: F.struct(v.alias("content"), F.lit(0.9).alias("confidence"))
    seg = F.when(F.col("c_acctbal") < 0, F.lit("null")).otherwise(F.col("c_mktsegment"))
    wrapped = c.select(wrap(F.col("c_custkey")).alias("id"), wrap(F.col("c_name")).alias("c_name"),
                       wrap(seg).alias("c_mktsegment"), F.col("c_acctbal"))
    return U.unwrap_fields(wrapped)

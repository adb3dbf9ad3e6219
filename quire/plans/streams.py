"""Streaming queries: the events table is landed as daily files and consumed
incrementally (T1 ingest, T2 upsert). Each call uses fresh folders under the
shared checkpoint directory."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.plans.registry import register
from quire.plans.upserts import COLS, LAST_WINS_SQL, SEQ
from quire.sources import upsert as U
from quire.sources.tables import Tables
from quire.streaming import incremental as S


def _landed(spark, sf_dir, name):
    d = S.stream_dirs(spark, name)
    ev = Tables(spark, sf_dir).events.select(*COLS).withColumn("day", F.to_date("ts"))
    S.land_files(ev, d["source"], partition_col="day")
    schema = spark.read.parquet(d["source"]).schema
    return d, schema


@register("stream_ingest", oracle="SELECT user_id, event_id, ts, event_type, value FROM events")
def stream_ingest(spark, sf_dir):
    d, schema = _landed(spark, sf_dir, "ingest")
    S.ingest_available(spark, d["source"], schema, d["sink"], d["checkpoint"], max_files_per_trigger=8)
    # a restart finds nothing new: the checkpoint remembers every file
    again = S.ingest_available(spark, d["source"], schema, d["sink"], d["checkpoint"])
    if again != 0:
        raise RuntimeError(f"restart re-processed {again} rows")
    return spark.read.parquet(d["sink"]).select(*COLS)


@register("stream_upsert", oracle=LAST_WINS_SQL)
def stream_upsert(spark, sf_dir):
    d, schema = _landed(spark, sf_dir, "upsert")
    S.upsert_stream(spark, d["source"], schema, d["table"], d["checkpoint"], "user_id", SEQ,
                    max_files_per_trigger=10)
    cur = U.read_current(spark, d["table"])
    return cur.select(F.col("user_id").cast("string").alias("id"), *COLS)

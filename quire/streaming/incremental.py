"""Incremental ingest and incremental upsert as Structured Streaming jobs.

Both run with ``trigger(availableNow=True)``: every file present when the
query starts is processed (in as many micro-batches as the rate limit
asks), then the query stops. The checkpoint records which files were
taken, so a restart processes only new files — the "skip finished work"
rule of the batch pipeline, with exactly-once file tracking and recovery
after executor or driver loss handled by Spark.

Checkpoints and sinks belong in the shared folder named by
``spark.checkpoint.dir``; ``stream_dirs`` derives them from it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.layout import LAYOUT_SCHEMA
from quire.session import checkpoint_dir, cut_lineage, small_files
from quire.sources import layouts as LY
from quire.sources import upsert as U
from quire.sources.files import listed, make_folder


def stream_dirs(spark: SparkSession, name: str) -> dict[str, str]:
    base = f"{checkpoint_dir(spark).rstrip('/')}/quire-streams/{name}-{uuid.uuid4().hex[:12]}"
    return {"source": f"{base}/source", "sink": f"{base}/sink", "checkpoint": f"{base}/checkpoint",
            "table": f"{base}/table"}


def land_files(df: DataFrame, path: str, partition_col: str | None = None, fmt: str = "parquet") -> None:
    """Write ``df`` as files a file-stream source can pick up (one file set per partition)."""
    w = df.write.mode("append").format(fmt)
    if partition_col:
        w = w.partitionBy(partition_col)
    w.save(path)


def ingest_available(spark: SparkSession, source: str, schema: T.StructType, sink: str,
                     checkpoint: str, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> int:
    """Copy every not-yet-seen file of ``source`` to the ``sink`` table; returns rows taken."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (r.load(source).writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(p.get("numInputRows", 0) for p in q.recentProgress)


def upsert_stream(spark: SparkSession, source: str, schema: T.StructType, table: str, checkpoint: str,
                  key: str, seq: Sequence[str], fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> None:
    """Every micro-batch is merged into the versioned collection at ``table``.

    Idempotent by ``batch_id``: a micro-batch replayed after a failure finds
    its id in the collection's pointer and writes nothing (and the merge
    is last-wins by ``seq`` anyway).
    """
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)

    def apply(batch: DataFrame, batch_id: int) -> None:
        U.upsert_table(batch.sparkSession, table, batch, key, seq, batch_id=batch_id)

    q = (r.load(source).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def ingest_layouts(spark: SparkSession, root: str, sink: str, checkpoint: str, schema: T.StructType = LAYOUT_SCHEMA,
                   max_files_per_trigger: int | None = None) -> int:
    """T1 as in the reference's layout step: every ``*.ocr.json`` below ``root`` that was not
    seen before is parsed into ``sink``, a folder per micro-batch (a replayed batch
    overwrites its own); a rerun takes only files added since. Returns the rows taken.
    ``ingested`` reads the sink.

    The stream's source are lists of files in the checkpoint folder, not the files, whose names
    the driver would all hold: tasks list ``root``, and files that are in no list yet make new
    lists, of ``max_files_per_trigger`` files each, the oldest first."""
    LY.there(root)
    lists, taken = f"{checkpoint}/lists", [0]
    make_folder(lists)
    found = listed(spark, root, "*" + LY.SUFFIX)
    known = spark.read.schema("file string, bytes long").parquet(lists).select("file").hint("merge")
    new = cut_lineage(found.join(known, "file", "left_anti"), "new-files")
    if not new.isEmpty():
        w = new.coalesce(1).sortWithinPartitions("modified", "file").select("file", "bytes").write.mode("append")
        (w.option("maxRecordsPerFile", max_files_per_trigger) if max_files_per_trigger else w).parquet(lists)
    r = spark.readStream.schema("file string, bytes long")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", 1)

    def run(batch: DataFrame, batch_id: int) -> None:
        path = f"{sink}/batch={batch_id}"
        LY.parsed_files(batch, schema).write.mode("overwrite").parquet(path)
        taken[0] += batch.sparkSession.read.parquet(path).count()

    with small_files(spark):  # a stream takes the settings of its start along
        q = (r.parquet(lists).writeStream.foreachBatch(run)
             .option("checkpointLocation", f"{checkpoint}/stream").trigger(availableNow=True).start())
    q.awaitTermination()
    return taken[0]


def ingested(spark: SparkSession, sink: str) -> tuple[DataFrame, DataFrame]:
    """(layouts, rejects) of a sink of ``ingest_layouts``, with the number of their batch."""
    return LY.parsed(spark.read.parquet(sink), ["batch"])


def batches(spark: SparkSession, sink: str) -> list[int]:
    """Numbers of the micro-batches in a sink of ``ingest_layouts``."""
    names = LY.listing(spark, sink, "*.parquet").select(F.regexp_extract("file", r"/batch=([0-9]+)/[^/]+$", 1).cast("int")).distinct()
    return sorted(r[0] for r in names.collect())

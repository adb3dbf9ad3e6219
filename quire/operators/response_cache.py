"""A stored response cache (J6): answers outlive the job that computed them.

Entries are rows (key, response) in folders by the first two digits of the key, so a lookup
reads the folders its keys are in. A batch of requests computes every missing key once,
however many requests share it, and appends the new answers when all of them are there; a
job that fails leaves the cache as it was.

Jobs that append at the same time do not disturb each other, but each computes what it
misses; of two answers to one key the first by time is used. To compute a key once for many
clients at once, let their requests land as files and answer them by one stream
(``serve``): its batches follow one another.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.pairing import cache_key
from quire.session import cut_lineage

ENTRY = "key string, response string, stored timestamp, prefix string"


class Answers(NamedTuple):
    rows: DataFrame    # the requests with key, response and hit
    computed: int      # keys that were computed for them


def prefix_of(key) -> F.Column:
    return F.substring(key, 1, 2)


def entries(spark: SparkSession, path: str, prefixes: Sequence[str] | None = None) -> DataFrame:
    """(key, response) of the cache, one row a key; of the given folders only."""
    try:
        # a folder name like 07 is text, so the schema is given
        df = spark.read.schema(ENTRY).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], ENTRY)
    if prefixes is not None:
        df = df.filter(F.col("prefix").isin(list(prefixes)))
    return df.groupBy("key").agg(F.min_by("response", "stored").alias("response"))


def answer(path: str, requests: DataFrame, key_cols: Sequence[str], compute: Callable[[DataFrame], DataFrame]) -> Answers:
    """Answer every request from the cache at ``path`` or by ``compute``, which gets the
    distinct missing requests (key, *key_cols) and returns (key, response); a null response
    is a failure, given back but not stored."""
    spark = requests.sparkSession
    asked = requests.withColumn("key", cache_key(key_cols))
    keys = cut_lineage(asked.select("key", *key_cols).dropDuplicates(["key"]), "cache-keys")
    prefixes = [r[0] for r in keys.select(prefix_of("key")).distinct().collect()]  # 256 at most
    known = cut_lineage(entries(spark, path, prefixes).join(keys.select("key"), "key", "left_semi"), "cache-hits")
    # written once: the model is not called again when the answers are stored and joined
    fresh = cut_lineage(compute(keys.join(known.select("key"), "key", "left_anti")).select("key", "response"), "cache-fresh")
    new = fresh.filter(F.col("response").isNotNull())
    computed = new.count()
    if computed:
        new.select("key", "response", F.current_timestamp().alias("stored"), prefix_of("key").alias("prefix")).repartition("prefix") \
           .write.mode("append").partitionBy("prefix").parquet(path)
    full = known.withColumn("hit", F.lit(True)).unionByName(fresh.withColumn("hit", F.lit(False)))
    return Answers(asked.join(full, "key", "left"), computed)


def serve(spark: SparkSession, source: str, schema: T.StructType, path: str, sink: str, checkpoint: str, key_cols: Sequence[str],
          compute: Callable[[DataFrame], DataFrame], max_files_per_trigger: int | None = None) -> None:
    """Answer all requests that have landed as JSON files in ``source`` and not been answered
    yet, batch after batch, into ``sink`` (a folder per batch, so a replay overwrites it)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)

    def run(batch: DataFrame, batch_id: int) -> None:
        answer(path, batch, key_cols, compute).rows.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    q = r.json(source).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()

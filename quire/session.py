"""Session construction and cluster-wide settings.

On a cluster the session already exists and carries the operator's
settings; ``build_session`` is for tests, the bench and local runs.
``checkpoint_dir`` reads the shared folder named by ``spark.checkpoint.dir``;
where it is unset, a local session (as in tests) gets a folder of its own and
a cluster session an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on: AQE re-plans joins and coalesces /
# splits shuffle partitions at runtime from real sizes; skew join splits a
# hot key's partition instead of leaving one straggler task.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "quire", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def let_workers_import(spark: SparkSession, root: str) -> None:
    """Python workers look for modules below ``root`` too, wherever the job was started from.
    On a cluster, ship the package as usual (``--py-files``); this then changes nothing."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder. A local session without one gets one; on a cluster a
    machine's own folder would lose what other machines write, so that is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="quire-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


#: Bytes that opening a file counts as where a folder has a small file per document. Spark's
#: 4 MB make a task of some thirty files, and the driver keeps a record of every task.
SMALL_FILE_BYTES = 64 << 10


@contextmanager
def small_files(spark: SparkSession):
    """Reads that run or streams that start inside put many small files into a task."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(SMALL_FILE_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Most bytes of an Arrow batch inside ``small_batches``. Spark's 64 MB are held in the executor
#: and in the Python worker, of every task.
SMALL_BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession):
    """Jobs that run inside send their rows to Python in Arrow batches of few bytes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(SMALL_BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Most rows of an Arrow batch inside ``few_rows``. Ten thousand, as is usual, become 120 MB where
#: a row is a vector of 1536 numbers.
FEW_ROWS = 1024


@contextmanager
def few_rows(spark: SparkSession):
    """Jobs that run inside send few rows at once to Python and back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(FEW_ROWS, int(before)) if int(before) > 0 else FEW_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """Path of a new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/quire-tables/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and
    read it back: one computation, columnar storage, and a lineage that
    restarts from the table if an executor is lost later."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_tables(spark: SparkSession) -> None:
    """Remove the intermediate tables of this library from the checkpoint folder. For the end
    of a job: results that were not written elsewhere can no longer be read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/quire-tables")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

"""Calls of a model or service from Spark tasks: an outcome for every row, and jobs that can
be stopped and run again (E1, E14, E19).

* ``call_outcomes`` gives the model bounded frames of rows. A frame that fails is cut in
  halves until the rows that make it fail stand alone; only those are retried and end with
  an ``error``, all others have their result. A ``Transient`` failure (a busy service) is
  retried for the whole frame, with random exponential back-off.
* ``run_job`` keeps its results in a folder. Rows that have a result are never asked for
  again: the pending ones are found by an anti join, written as a work table and called in
  waves of ``concurrency`` tasks of about ``rows_per_commit`` rows. A task's results become
  visible when the task ends, not when the job does, so a lost executor or a job that is
  started again costs at most the tasks that were running. Failed rows are called again,
  up to ``max_rounds`` times in all.
* ``Pacer`` keeps the calls of all tasks of a wave below a rate, and pauses when the service
  says that few requests remain.
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.pairing import pending

#: Rows and bytes of text given to a model at once.
CALL_ROWS, CALL_BYTES = 64, 4 << 20
#: Back-off between attempts, seconds: first and longest wait.
FIRST_WAIT, LONGEST_WAIT = 1.0, 20.0
OUTCOME = "error string, calls int, seconds double"


class Transient(Exception):
    """The service was busy or out of reach: the same call may succeed later."""


class Pacer:
    """At most ``per_minute`` calls by ``concurrency`` tasks together: each waits its share.
    ``after`` pauses a window when fewer requests remain than there are tasks."""

    def __init__(self, per_minute: float, concurrency: int = 1, window: float = 60.0, clock=time.monotonic, sleep=time.sleep):
        self.every = 60.0 * concurrency / per_minute
        self.concurrency, self.window, self.clock, self.sleep = concurrency, window, clock, sleep
        self.next = None

    def before(self) -> None:
        now = self.clock()
        if self.next is not None and self.next > now:
            self.sleep(self.next - now)
            now = self.next
        self.next = now + self.every

    def after(self, remaining) -> None:
        """``remaining``: the header of the last reply (text, a number, or None)."""
        try:
            left = None if remaining is None else int(remaining)
        except ValueError:
            left = None
        if left is not None and left < self.concurrency:
            self.next = max(self.next or 0.0, self.clock() + self.window)


def _frames(pdf: pd.DataFrame, cols: Sequence[str], rows: int, limit: int):
    """``pdf`` in pieces of at most ``rows`` rows and about ``limit`` bytes of text."""
    size = sum((pdf[c].map(lambda x: len(x) if isinstance(x, (str, bytes)) else 8) for c in cols), pd.Series(0, index=pdf.index))
    first, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > first and (i - first >= rows or held + n > limit):
            yield pdf.iloc[first:i]
            first, held = i, 0
        held += n
    if first < len(pdf):
        yield pdf.iloc[first:]


def settle(frame: pd.DataFrame, call: Callable, max_attempts: int, pacer: Pacer | None = None, sleep=time.sleep) -> list[tuple]:
    """(result row as a dict or None, error, calls, seconds) of every row of ``frame``."""

    def attempt(part):
        if pacer:
            pacer.before()
        t0 = time.perf_counter()
        out = call(part)
        if pacer and "remaining_requests" in out:
            pacer.after(list(out["remaining_requests"])[-1] if len(part) else None)
        if isinstance(out, dict) and len(out) == 1 and all(isinstance(x, np.ndarray) for x in next(iter(out.values()))):
            (name, vectors), = out.items()
            out = [{name: x} for x in vectors]  # vectors need no frame
        else:
            out = pd.DataFrame(out).to_dict("records")
        if len(out) != len(part):
            raise ValueError(f"{len(out)} results for {len(part)} rows")
        return out, time.perf_counter() - t0

    def solve(part, before):
        calls = 0
        while True:
            calls += 1
            try:
                out, secs = attempt(part)
                return [(r, None, before + calls, secs / len(part)) for r in out]
            except Exception as e:  # the rows fail, the task goes on
                error, busy = f"{type(e).__name__}: {e}", isinstance(e, Transient)
            if not busy and len(part) > 1:
                half = len(part) // 2
                return solve(part.iloc[:half], before + calls) + solve(part.iloc[half:], before + calls)
            if calls >= max_attempts:
                return [(None, error, before + calls, None)] * len(part)
            sleep(min(LONGEST_WAIT, FIRST_WAIT * 2 ** (calls - 1)) * random.uniform(0.5, 1.0))

    return solve(frame, 0) if len(frame) else []


def call_outcomes(df: DataFrame, ids: Sequence[str], cols: Sequence[str], call: Callable[[pd.DataFrame], object], schema: str,
                  rows: int = CALL_ROWS, max_bytes: int = CALL_BYTES, max_attempts: int = 1, pacer: Callable[[], Pacer] | None = None) -> DataFrame:
    """(ids, the columns of ``schema``, error, calls, seconds): every row once. ``call`` gets a
    frame of ``cols`` and returns a frame (or dict of lists) with the columns of ``schema``, a
    row for a row. Write the result before reading it twice: a model is called per read."""
    src = df.select(*ids, *[c for c in cols if c not in ids])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.select(*ids).schema)
    names = df.sparkSession.createDataFrame([], schema).columns
    ids, cols = list(ids), list(cols)

    def run(batches):
        pace = pacer() if pacer else None
        for pdf in batches:
            for frame in _frames(pdf, cols, rows, max_bytes):
                found = settle(frame[cols].reset_index(drop=True), call, max_attempts, pace)
                out = {c: frame[c].tolist() for c in ids}
                out |= {c: pd.Series([None if r[0] is None else r[0].get(c) for r in found], dtype=object) for c in names}
                yield pd.DataFrame(out | {"error": [r[1] for r in found], "calls": [r[2] for r in found], "seconds": pd.Series([r[3] for r in found], dtype="float64")})

    return src.mapInPandas(run, f"{kinds}, {schema}, {OUTCOME}")


# ---- jobs that can be run again ----------------------------------------------------

def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def job_results(spark: SparkSession, path: str, id_col: str) -> DataFrame | None:
    """The outcome of every row called so far, once each: its result, or else its last error;
    ``round`` says when. None if nothing was stored."""
    log = _stored(spark, f"{path}/results")
    if log is None:
        return None
    cols = [c for c in log.columns if c != id_col]
    best = F.max_by(F.struct(*cols), F.struct(F.col("error").isNull().alias("ok"), "round"))
    return log.groupBy(id_col).agg(best.alias("r")).select(id_col, *[F.col(f"r.{c}").alias(c) for c in cols])


def run_job(path: str, requests: DataFrame, id_col: str, cols: Sequence[str], call: Callable[[pd.DataFrame], object], schema: str,
            concurrency: int = 8, rows_per_commit: int = 1000, max_rounds: int = 2, rows: int = CALL_ROWS,
            pacer: Callable[[], Pacer] | None = None) -> DataFrame:
    """Call the model for every request that has no result at ``path`` yet; returns
    ``job_results``. ``call`` sees the number of the round in the column ``round``, too.
    Ids must be distinct; requests that left the input keep their results."""
    spark = requests.sparkSession
    for _ in range(max_rounds):
        done = job_results(spark, path, id_col)
        tried = requests.withColumn("round", F.lit(1)) if done is None else requests.join(done.select(id_col, "round", "error"), id_col, "left").withColumn(
            "round", F.coalesce(F.col("round"), F.lit(0)) + 1)
        if done is not None:
            finished = done.filter(F.col("error").isNull() | (F.col("round") >= max_rounds)).select(id_col)
            tried = pending(tried, finished, id_col)
        if not _run_round(path, tried.select(id_col, "round", *[c for c in cols if c != id_col]), id_col, cols, call, schema, concurrency, rows_per_commit, rows, pacer):
            break
    found = job_results(spark, path, id_col)
    return found if found is not None else spark.createDataFrame([], f"{id_col} {requests.schema[id_col].dataType.simpleString()}, {schema}, {OUTCOME}, round int")


def _run_round(path, tried, id_col, cols, call, schema, concurrency, rows_per_commit, rows, pacer) -> int:
    """One call of every row of ``tried``; returns how many there were."""
    spark, n = tried.sparkSession, tried.count()
    if not n:
        return 0
    tasks = -(-n // rows_per_commit)
    work = f"{path}/work/{uuid.uuid4().hex}"
    task = F.pmod(F.xxhash64(id_col), F.lit(tasks)).cast("int")
    placed = tried.withColumn("task", task).withColumn("wave", F.floor(F.col("task") / concurrency).cast("int"))
    placed.write.partitionBy("wave").parquet(work)
    for wave in range(-(-tasks // concurrency)):
        rows_of = spark.read.parquet(work).filter(F.col("wave") == wave)
        dealt = rows_of.repartitionById(min(concurrency, tasks), F.pmod("task", F.lit(concurrency)).cast("int"))
        out = call_outcomes(dealt, [id_col, "round"], [*cols, "round"], call, schema, rows=rows, pacer=pacer)
        # version 2 of the committer moves a task's file to its place when the task ends
        out.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(f"{path}/results")
    return n


# ---- embeddings (E14) -----------------------------------------------------------------

def embed_outcomes(df: DataFrame, text: str, embed_fn: Callable[[list[str]], Sequence], dim: int, id_col: str,
                   max_attempts: int = 6, rows: int = CALL_ROWS, pacer: Callable[[], Pacer] | None = None) -> DataFrame:
    """(id, embedding array<float>, error, calls, seconds): ``embed_fn`` gets a list of texts,
    a missing one as ''. A row whose call fails, or whose vector has not ``dim`` numbers,
    has an error and no vector; it costs no other row its vector."""

    def numbers(v):
        if isinstance(v, np.ndarray) and v.ndim == 1 and v.dtype.kind in "iuf":
            return v.astype(np.float32)
        return np.array([float(x) for x in v], np.float32)

    def call(frame):
        vectors = [numbers(v) for v in embed_fn(frame[text].fillna("").tolist())]
        wrong = {len(v) for v in vectors} - {dim}
        if wrong:
            raise ValueError(f"expected {dim} numbers, got {min(wrong)}")
        return {"embedding": vectors}

    return call_outcomes(df, [id_col], [text], call, "embedding array<float>", rows=rows, max_attempts=max_attempts, pacer=pacer)

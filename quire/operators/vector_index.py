"""Inverted-file vector index (R2b): vectors in cells around centroids, searched cell by
cell until no unread cell can matter.

* **Build.** Centroids come from MLlib k-means (cosine) on at most ``FIT_ROWS`` sampled
  vectors; every vector is indexed. Each goes to the cell of its nearest centroid, in one
  pass over Arrow batches; the table is written with a folder per cell, so reading a few
  cells reads a few folders. A large cell is many files: rows are dealt out by cell and a
  hash of the id. The cell table has each cell's centroid, its size, its largest angle and
  the mean square of what its vectors differ from their mean.
* **Search.** Queries go in blocks of bounded bytes. For each query the cells are ordered
  by what they may hold; every round reads the next cells of all queries of the block in
  one job (cells nobody asks for are pruned as partitions), scores a vector only with the
  queries that ask for its cell, and keeps a running top-k per task. A query is done when
  its rule says that the unread cells do not matter.
* **The rule.** ``recall=1.0``: by the triangle inequality on the sphere, a cell whose
  centroid is at angle t of the query and whose vectors are within r of the centroid holds
  no cosine above cos(max(0, t - r)); the search ends when that is below the k-th best, so
  the result equals the exhaustive search. ``recall=p``: the cosines of a cell are taken as
  normal around the cosine with the cell's mean; the search ends when the vectors expected
  above the k-th best in all unread cells are fewer than (1 - p) * k. Nothing else cuts the
  search: no query gets fewer results or a fixed number of cells.

Null vectors are not indexed; a zero vector has cosine 0 with everything and lies in a cell
of its own. Ties are broken by id. A collection without vectors gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quire.operators.retrieval import QUERY_BLOCK_BYTES, SCORE_BLOCK_BYTES, SCORE_DIGITS, SLACK, RunningTop, _id_array, _unit, top_k
from quire.session import cut_lineage, fresh_folder

#: Vectors the centroids are fitted on, at most (a sample of the collection; all are indexed).
FIT_ROWS = 100_000
FIT_ITERATIONS = 10
MAX_CELLS = 4096
#: Cells read in a query's first round; doubled from round to round.
FIRST_CELLS = 4
#: Cell of the zero vectors, which have no direction.
ZERO_CELL = -1


class VectorIndex(NamedTuple):
    """A written index; ``open`` it again by its folder."""
    path: str
    cells: DataFrame   # (cell, centroid array<double>, n, radius, mean array<double>, spread)

    @staticmethod
    def open(spark: SparkSession, path: str) -> "VectorIndex":
        return VectorIndex(path, spark.read.parquet(f"{path}/cells"))

    def vectors(self, cells: list[int] | None = None) -> DataFrame:
        """(vid, v, cell), of the given cells only; theirs alone are read."""
        df = self.cells.sparkSession.read.parquet(f"{self.path}/vectors")
        return df if cells is None else df.filter(F.col("cell").isin(cells))


class SearchReport(NamedTuple):
    """What a search read: pairs of query and vector scored, of all pairs there are, and rounds."""
    scored: int
    pairs: int
    rounds: int

    @property
    def share(self) -> float:
        return self.scored / self.pairs if self.pairs else 0.0


# ---- build -------------------------------------------------------------------------

def fit_centroids(vectors: DataFrame, vec: str, cells: int, seed: int = 7, rows: int = FIT_ROWS) -> np.ndarray:
    """Unit centroids (cells x dim) from a sample of at most about ``rows`` vectors."""
    v = vectors.select(array_to_vector(F.col(vec)).alias("x"))
    n = v.count()
    sample = v.sample(fraction=min(1.0, rows / n), seed=seed) if n > rows else v
    model = KMeans(k=cells, featuresCol="x", distanceMeasure="cosine", initMode="random", maxIter=FIT_ITERATIONS, seed=seed).fit(sample)
    m = np.array(model.clusterCenters())
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def build_index(vectors: DataFrame, vid: str, vec: str, cells: int | None = None, path: str | None = None) -> VectorIndex:
    """Write the index of ``vectors`` (vid, vec); ``cells`` is the square root of their
    number unless given, ``MAX_CELLS`` at most."""
    spark = vectors.sparkSession
    path = path or fresh_folder(spark, "vector-index")
    rows = vectors.select(F.col(vid).alias("vid"), F.col(vec).cast("array<double>").alias("v")).filter(F.col("v").isNotNull())
    some = rows.filter(F.exists("v", lambda x: x != 0))
    n = some.count()
    centroids = fit_centroids(some, "v", min(n, cells or min(MAX_CELLS, max(2, round(n ** 0.5))))) if n > 1 else np.zeros((0, 0))
    sent = spark.sparkContext.broadcast(centroids)

    def assign(batches):
        c = sent.value
        for b in batches:
            for lo in range(0, b.num_rows, max(1, SCORE_BLOCK_BYTES // (8 * max(1, len(c))))):
                part = b.slice(lo, max(1, SCORE_BLOCK_BYTES // (8 * max(1, len(c)))))
                u = _unit(part.column("v"))
                if len(c):
                    cos = u @ c.T
                    cell = cos.argmax(axis=1)
                    angle = np.arccos(np.clip(cos[np.arange(len(u)), cell], -1, 1))
                else:
                    cell, angle = np.zeros(len(u), np.int64), np.full(len(u), np.pi)
                cell = np.where(u.any(axis=1), cell, ZERO_CELL)
                yield pa.RecordBatch.from_arrays([part.column("vid"), part.column("v"), pa.array(cell.astype(np.int32)), pa.array(angle)], names=["vid", "v", "cell", "angle"])

    kind = rows.schema["vid"].dataType.simpleString()
    placed = cut_lineage(rows.mapInArrow(assign, f"vid {kind}, v array<double>, cell int, angle double"), "cells")
    write_cells(placed, f"{path}/vectors")
    per = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")).join(means(placed), "cell")
    given = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(centroids)], "cell int, centroid array<double>")
    per.join(given, "cell", "left").write.mode("overwrite").parquet(f"{path}/cells")
    return VectorIndex.open(spark, path)


def write_cells(placed: DataFrame, path: str) -> None:
    """A folder per cell; a cell's rows go to several tasks, so a large one is many files."""
    spread = F.pmod(F.xxhash64("vid"), F.lit(8))
    placed.select("vid", "v", "cell").withColumn("_part", spread).repartition("cell", "_part").drop("_part").write.mode("overwrite").partitionBy("cell").parquet(path)


def means(placed: DataFrame) -> DataFrame:
    """(cell, mean, spread): the mean of a cell's unit vectors, and their mean square
    deviation from it per dimension; whole vectors are summed in the map task."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    unit = F.when(size > 0, F.transform("v", lambda x: x / size)).otherwise(F.col("v"))
    m = placed.select("cell", array_to_vector(unit).alias("x")).groupBy("cell").agg(
        vector_to_array(Summarizer.mean(F.col("x"))).alias("mean"), F.avg(F.when(F.col("cell") == ZERO_CELL, 0.0).otherwise(1.0)).alias("square"))
    off = F.col("square") - F.aggregate("mean", F.lit(0.0), lambda a, x: a + x * x)
    return m.select("cell", "mean", (F.greatest(off, F.lit(0.0)) / F.size("mean")).alias("spread"))


# ---- search --------------------------------------------------------------------------

class Block(NamedTuple):
    """Queries searched together, and the cell table."""
    qids: list
    unit: np.ndarray      # queries x dim
    cells: np.ndarray     # cell ids
    n: np.ndarray         # vectors in each cell
    order: np.ndarray     # queries x cells: places of the cells, the most promising first
    bound: np.ndarray     # queries x cells, in that order: the rule's view of the cell


def normal_above(z: np.ndarray) -> np.ndarray:
    """Share of a normal distribution above z (Abramowitz and Stegun 7.1.26: error below 1e-7)."""
    x = np.abs(z) / np.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    tail = 0.5 * t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * np.exp(-x * x)
    return np.where(z >= 0, tail, 1 - tail)


def open_block(index: VectorIndex, table: dict, qids: list, unit: np.ndarray) -> Block:
    cells, n = table["cell"], table["n"]
    zero = cells == ZERO_CELL
    cos = np.clip(unit @ table["centroid"].T, -1, 1)
    far = np.cos(np.maximum(0.0, np.arccos(cos) - table["radius"]))
    far[:, zero] = 0.0
    far[~unit.any(axis=1)] = 0.0
    order = np.argsort(-far, axis=1, kind="stable")
    return Block(qids, unit, cells, n, order, np.take_along_axis(far, order, axis=1))


def expected_block(b: Block, table: dict) -> Block:
    """Ordered by the cosine with the cell's mean plus three deviations."""
    score = b.unit @ table["mean"].T + 3 * np.sqrt(table["spread"])
    order = np.argsort(-score, axis=1, kind="stable")
    return b._replace(order=order, bound=np.take_along_axis(score, order, axis=1))


def matter(b: Block, table: dict, at: np.ndarray, kth: np.ndarray, k: int, recall: float) -> np.ndarray:
    """Whether a query's unread cells (from its place ``at`` on) may still change its result."""
    unread = np.arange(len(b.cells)) >= at[:, None]
    if recall >= 1.0:
        return (unread & (b.bound >= kth[:, None] - SLACK)).any(axis=1)
    mu = np.take_along_axis(b.unit @ table["mean"].T, b.order, axis=1)
    sd = np.maximum(np.sqrt(table["spread"])[b.order], 1e-9)
    above = np.where(np.isinf(kth)[:, None], 1.0, normal_above((kth[:, None] - mu) / sd))
    return (np.where(unread, above * b.n[b.order], 0).sum(axis=1) > (1 - recall) * k) & unread.any(axis=1)


def read_round(index: VectorIndex, b: Block, asked: np.ndarray, k: int, qid_kind: str) -> DataFrame:
    """(qid, vid, score): the k best per task and query among the cells that ``asked``
    (queries x cells, by place in the cell table) marks."""
    own = np.flatnonzero(asked.any(axis=0))
    sent = index.cells.sparkSession.sparkContext.broadcast((b.qids, b.unit, {int(b.cells[c]): np.flatnonzero(asked[:, c]) for c in own}))
    rows = index.vectors([int(c) for c in b.cells[own]])
    qid_type = to_arrow_type(T.DataType.fromDDL(qid_kind))

    def run(batches):
        qids, unit, wanted = sent.value
        top = RunningTop(len(qids), k)
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            cut = np.r_[0, np.flatnonzero(np.diff(cell)) + 1, len(cell)]
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                ask = wanted[int(cell[lo])]
                step = max(1, SCORE_BLOCK_BYTES // (8 * max(len(ask), unit.shape[1])))
                for at in range(lo, hi, step):
                    part = batch.slice(at, min(step, hi - at))
                    top.add_for(ask, _id_array(part.column("vid")), np.round(_unit(part.column("v")) @ unit[ask].T, SCORE_DIGITS))
        if top.ids is not None:
            kind = batch.schema.field("vid").type
            yield pa.RecordBatch.from_arrays([pa.array([qids[i] for i in top.query]).cast(qid_type), pa.array(top.ids.tolist()).cast(kind), pa.array(top.score)], names=["qid", "vid", "score"])

    return cut_lineage(rows.mapInArrow(run, f"qid {qid_kind}, vid {rows.schema['vid'].dataType.simpleString()}, score double"), "ivf-round"), sent


def search_block(index: VectorIndex, table: dict, b: Block, k: int, recall: float, qid_kind: str):
    """The rounds of one block: its top-k as a table, pairs scored, rounds."""
    place = {q: i for i, q in enumerate(b.qids)}
    at, step = np.zeros(len(b.qids), np.int64), FIRST_CELLS
    kth = np.full(len(b.qids), -np.inf)
    best, scored, rounds = None, 0, 0
    live = np.ones(len(b.qids), bool) if len(b.cells) else np.zeros(len(b.qids), bool)
    while live.any():
        asked = np.zeros((len(b.qids), len(b.cells)), bool)
        ahead = (np.arange(len(b.cells)) >= at[:, None]) & (np.arange(len(b.cells)) < at[:, None] + step) & live[:, None]
        if recall >= 1.0:
            ahead &= b.bound >= kth[:, None] - SLACK
        np.put_along_axis(asked, b.order, ahead, axis=1)
        scored += int((asked * b.n).sum())
        found, sent = read_round(index, b, asked, k, qid_kind)
        best = cut_lineage(top_k(found if best is None else best.unionByName(found), "qid", "vid", k).drop("rank"), "ivf-best")
        sent.destroy()
        least = best.groupBy("qid").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == k).collect()  # one row a query of the block
        for r in least:
            kth[place[r["qid"]]] = r["kth"]
        at, step, rounds = np.where(live, at + step, at), step * 2, rounds + 1
        live &= matter(b, table, at, kth, k, recall)
    return best, scored, rounds


def search(index: VectorIndex, queries: DataFrame, qid: str, qvec: str, k: int = 3, recall: float = 1.0) -> tuple[DataFrame, SearchReport]:
    """Cosine top-k per query -> (qid, rank, vid, score), and what was read for it.

    ``recall=1.0`` gives the exact result; a lower value ends the search of a query when fewer
    than that share of its neighbours is expected to be missing. Query ids must be distinct."""
    spark = queries.sparkSession
    rows = sorted(index.cells.collect(), key=lambda r: r["cell"])  # at most MAX_CELLS + 1 rows
    kind = queries.schema[qid].dataType.simpleString()
    vid_kind = index.vectors().schema["vid"].dataType.simpleString() if rows else "long"
    q = cut_lineage(queries.select(F.col(qid).alias("qid"), F.col(qvec).cast("array<double>").alias("v")).filter(F.col("v").isNotNull()), "queries")
    shape = q.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim")).first()
    parts, scored, rounds, total = [], 0, 0, sum(r["n"] for r in rows)
    if rows and shape["n"]:
        dim = len(rows[-1]["mean"])
        table = {"cell": np.array([r["cell"] for r in rows]), "n": np.array([r["n"] for r in rows]), "radius": np.array([r["radius"] for r in rows]),
                 "centroid": np.array([r["centroid"] or [0.0] * dim for r in rows]), "mean": np.array([r["mean"] for r in rows]), "spread": np.array([r["spread"] for r in rows])}
        blocks = max(1, -(-shape["n"] * 8 * (dim + 4 * len(rows)) // QUERY_BLOCK_BYTES))
        for i in range(blocks):
            own = q.filter(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == i).collect()
            if not own:
                continue
            b = open_block(index, table, [r["qid"] for r in own], _unit(pa.array([r["v"] for r in own], pa.list_(pa.float64()))))
            best, s, n = search_block(index, table, b if recall >= 1.0 else expected_block(b, table), k, recall, kind)
            parts.append(best)
            scored, rounds = scored + s, rounds + n
    report = SearchReport(scored, total * (shape["n"] or 0), rounds)
    if not parts:
        return spark.createDataFrame([], f"qid {kind}, rank int, vid {vid_kind}, score double"), report
    return top_k(reduce(DataFrame.unionByName, parts), "qid", "vid", k).select("qid", "rank", "vid", "score"), report

"""Vector code compression: product codes found by Orchard's search.

A vector of integers is cut into equal consecutive parts; each part is replaced
by the index of the nearest entry of its position's codebook. The codebooks
start as parts of the vectors of least id and are improved in rounds: assign
every part, then replace each entry by the floor of the mean of its parts.

The nearest entry is found by Orchard's search. For each entry of a codebook
all entries are listed by their distance from it. A query starts at one entry,
walks that entry's list and evaluates the entries it has not marked as visited;
when one is nearer it jumps to that entry's list and starts there anew. It
stops beyond twice its current distance: an entry farther than that from the
current one cannot be nearer to the query, by the triangle inequality. Listed
entries at exactly twice the distance are still evaluated, so ties go to the
lower index. All arithmetic is on integers and exact; all queries of a block
walk their lists side by side in numpy, a few places of the list at a time.

Only codebooks (bounded by ``ENTRIES`` and the width of a vector) and per-task
sums for their entries pass through the driver; vectors are read from one
written table of integers in every round.

Kept rows: the vector is not null, has no null and no non-finite component, and
no component of 2^18 or more in magnitude (its squared distances would not fit
64 bits); the length is that of the kept vector of least id, and a multiple of
the number of parts. Other rows are dropped. Rows of equal id are ordered by
their vectors, null ids come last; repeated rows are kept and counted each.
Fewer than 256 kept rows make smaller codebooks. Null labels are one group.
No kept row gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import join_counted, written

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024
#: Largest magnitude of a component before scaling.
LIMIT = float(1 << 18)
#: Queries that walk their lists side by side, and places of a list looked at in one step.
BLOCK, STEP = 4096, 8


class Codebook(NamedTuple):
    """Entries (entries x places) of one part position, and of each entry the entries in
    order of their distance from it with these squared distances."""
    entries: np.ndarray
    near: np.ndarray
    far: np.ndarray


def codebook(entries: np.ndarray) -> Codebook:
    d = np.stack([((entries - e) ** 2).sum(axis=1) for e in entries])
    near = np.argsort(d, axis=1, kind="stable")
    return Codebook(entries, near, np.take_along_axis(d, near, axis=1))


def nearest(points: np.ndarray, book: Codebook, step: int = STEP) -> tuple[np.ndarray, np.ndarray, int]:
    """(index, squared distance) of each point's nearest entry, ties to the lower index;
    and how many distances were evaluated."""
    n, size = len(points), len(book.entries)
    index, dist = np.zeros(n, np.int64), ((points - book.entries[0]) ** 2).sum(axis=1)
    visited = np.zeros((n, size), bool)
    visited[:, 0] = True
    at = np.zeros(n, np.int64)  # place in the current entry's list
    live, evaluated = np.arange(n), n
    while len(live):
        places = at[live, None] + np.arange(step)
        inside = places < size
        places = np.minimum(places, size - 1)
        cand = book.near[index[live, None], places]
        reach = inside & (book.far[index[live, None], places] <= 4 * dist[live, None])
        row, col = np.nonzero(reach & ~visited[live[:, None], cand])
        entry = cand[row, col]
        visited[live[row], entry] = True
        d = np.full(cand.shape, np.iinfo(np.int64).max)
        d[row, col] = ((points[live[row]] - book.entries[entry]) ** 2).sum(axis=1)
        evaluated += len(row)
        least = d.min(axis=1)
        best = np.where(d == least[:, None], cand, size).min(axis=1)
        nearer = (least < dist[live]) | (least == dist[live]) & (best < index[live])
        jump = live[nearer]
        index[jump], dist[jump], at[jump] = best[nearer], least[nearer], 0
        at[live[~nearer]] += step
        live = live[nearer | reach[:, -1]]
    return index, dist, evaluated


def assign(vectors: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of every part of each vector, vectors x parts."""
    parts = np.split(vectors, len(books), axis=1)
    found = [nearest(p, b) for p, b in zip(parts, books, strict=True)]
    return np.stack([x[0] for x in found], axis=1), np.stack([x[1] for x in found], axis=1)


def integers(vec: Column) -> Column:
    """floor(1024 * x) of every component, null where the vector is not kept."""
    x = F.transform(vec, lambda v: v.cast("double"))
    ok = vec.isNotNull() & (F.size(vec) > 0) & F.forall(x, lambda v: F.coalesce((F.abs(v) < LIMIT) & ~F.isnan(v), F.lit(False)))
    return F.when(ok, F.transform(x, lambda v: F.floor(v * SCALE).cast("int")))


def prepared(rows: DataFrame, vec_id: str, vec: str, label: str, parts: int) -> tuple[DataFrame, int]:
    """The kept rows (vec_id, label, v) as a written table, and the length of v."""
    all_rows = rows.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), integers(F.col(vec)).alias("v"))
    t = written(all_rows.filter(F.col("v").isNotNull() & (F.size("v") % parts == 0)), "vectors")
    first = t.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v").alias("n")).head(1)
    width = first[0]["n"] if first else parts
    return t.filter(F.size("v") == width), width


def blocks(col: pa.Array, width: int):
    """(first row, vectors) of a list column, ``BLOCK`` rows at a time."""
    for first in range(0, len(col), BLOCK):
        part = col.slice(first, BLOCK)
        yield first, part.flatten().to_numpy().astype(np.int64).reshape(len(part), width)


def improved(table: DataFrame, width: int, books: np.ndarray) -> np.ndarray:
    """The codebooks (parts x entries x places) after one round of assigning and averaging."""
    parts, entries, places = books.shape
    sent = table.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        known = [codebook(b) for b in sent.value]
        total, count = np.zeros((parts, entries, places), np.int64), np.zeros((parts, entries), np.int64)
        for b in batches:
            for _, v in blocks(b.column(0), width):
                index, _ = assign(v, known)
                for p, own in enumerate(np.split(v, parts, axis=1)):
                    np.add.at(total[p], index[:, p], own)
                    count[p] += np.bincount(index[:, p], minlength=entries)
        part, entry = np.nonzero(count)
        sums = total[part, entry]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]),
                                          *(pa.array(np.ascontiguousarray(sums[:, k])) for k in range(places))], names=["part", "entry", "n", *(f"s{k}" for k in range(places))])

    sums = ", ".join(f"s{k} long" for k in range(places))
    found = table.select("v").mapInArrow(run, f"part int, entry int, n long, {sums}").groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(f"s{k}").alias(f"s{k}") for k in range(places)])
    out = books.copy()
    for r in found.toArrow().to_pylist():  # at most parts x entries rows
        out[r["part"], r["entry"]] = [r[f"s{k}"] // r["n"] for k in range(places)]
    sent.destroy()
    return out


def fit(table: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x places) of a prepared table."""
    first = table.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    start = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, width // parts)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    if len(first):
        for _ in range(rounds):
            books = improved(table, width, books)
    return books


def encode(table: DataFrame, width: int, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code array<int>, error) of a prepared table."""
    sent = table.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        known = [codebook(b) for b in sent.value]
        for b in batches:
            for first, v in blocks(b.column(2), width):
                index, dist = assign(v, known)
                cut = np.arange(len(v) + 1, dtype=np.int32) * index.shape[1]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(v)), b.column(1).slice(first, len(v)),
                                                  pa.ListArray.from_arrays(pa.array(cut), pa.array(index.astype(np.int32).ravel())), pa.array(dist.sum(axis=1))],
                                                 names=["vec_id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in table.schema}
    return table.select("vec_id", "label", "v").mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code array<int>, error long")


def decoded(books: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The vectors that codes (vectors x parts) stand for."""
    return np.concatenate([books[p][codes[:, p]] for p in range(len(books))], axis=1)


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(rows: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code array<int>, error) of the kept rows, and the codebooks."""
    table, width = prepared(rows, vec_id, vec, label, parts)
    books = fit(table, width, parts, entries, rounds)
    if not books.shape[1]:
        return table.select("vec_id", "label", F.array(F.lit(0)).alias("code"), F.lit(0).cast("long").alias("error")), books
    return encode(table, width, books), books


def code_report(rows: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label") -> DataFrame:
    """Per kept row: vec_id, code (two hex digits a part), error, label_error, codebooks_sha256."""
    coded, books = compress(rows, vec_id, vec, label)
    coded = written(coded, "codes")
    per = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n"))
    hexed = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return join_counted(coded, per, ["label"], "n").select(
        F.col("vec_id").alias(vec_id), hexed.alias("code"), "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))

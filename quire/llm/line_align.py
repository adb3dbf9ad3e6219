"""Line deduplication by pairwise alignment.

A line is compared by the hash of its words and by its occurrence number in
its document, so every compared line is distinct within its document. Lines
that several documents have are found by one aggregate; each names its first
holder, the document of least id, and how many documents hold it. Every later
holder is paired with the first holder: as many links as shared lines, never
all pairs of a group. Runs of lines are linked in the same way, so that a
passage meets the first document that has it, whoever had its single lines
before: of each line the shortest run of two lines or more and ``BLOCK_WORDS``
words or more that starts with it, and the one that ends with it. Every line of
a longer shared passage is in one of these runs. Two documents overlap if they share a rare line (held by
``RARE`` documents at most), at least two lines, or one of ``BLOCK_WORDS`` words or
more, however many documents hold it. A short frequent line met alone (a
greeting) is no overlap; it could not make a block either.

Overlapping pairs are aligned by patience: with all compared lines distinct,
the alignment is the longest chain of shared lines that rises in both
documents. Aligned lines that follow each other in both make a block; blocks
of ``BLOCK_WORDS`` words or more are deleted from the later document. A line
is only ever deleted where its first holder keeps it, so no text is lost.

Lines are split at line feeds and compared by their runs of digits, letters
a-z (A-Z lowered) and non-ASCII characters; lines without any (blank ones
too) are not compared, do not end a block and always stay. A null text stays
null with 0 lines. Documents are ordered by id, null first; rows with equal
id and equal text are one document, so a repeated row does not delete its
twin's lines; among rows with equal id but different texts a hash of the text
decides. Other columns are kept as they are, an empty table stays empty.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ALNUM, hash_spans, mix64, place, positional, slices, text_bytes, word_spans, written

RARE = 16
BLOCK_WORDS = 10


def line_table(rows: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, node, h, pos, words) of the compared lines and linked runs of (id, node, text):
    pos counts the compared lines of a text, h covers words and occurrence number of
    each line, words has the words of each line."""

    def run(batches):
        for b in batches:
            for first, end in slices(b.column(2)):
                own = b.slice(first, end - first)
                row, h, pos, words = compared(own.column(2))
                start, end = runs(row, words, block_words)
                key = np.r_[h, hash_runs(h, start, end)]
                at = np.r_[np.arange(len(h)), start]
                n = np.r_[np.ones(len(h), np.int64), end - start]
                cut = np.r_[0, np.cumsum(n)]
                each = np.repeat(at - cut[:-1], n) + np.arange(cut[-1])
                lists = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(words[each].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([own.column(0).take(pa.array(row[at])), own.column(1).take(pa.array(row[at])), pa.array(key.view(np.int64)),
                                                  pa.array(pos[at].astype(np.int32)), lists], names=["id", "node", "h", "pos", "words"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, node long, h long, pos int, words array<int>")


def runs(row: np.ndarray, words: np.ndarray, block_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the distinct shortest runs of two lines and ``block_words`` words or
    more that start or end with each line, inside its row."""
    n = len(row)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, total = np.arange(n), np.r_[0, np.cumsum(words)]
    end = np.maximum(np.searchsorted(total, total[:-1] + block_words), at + 2)
    start = np.minimum(np.searchsorted(total, total[1:] - block_words, side="right") - 1, at - 1)
    ahead = (end <= n) & (row[np.minimum(end, n) - 1] == row)
    back = (start >= 0) & (row[np.maximum(start, 0)] == row)
    both = np.unique(np.r_[at[ahead] * (n + 1) + end[ahead], start[back] * (n + 1) + at[back] + 1])
    return both // (n + 1), both % (n + 1)


def hash_runs(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the lines of each run, in order."""
    out = mix64((end - start).astype(np.uint64))
    live, k = np.arange(len(start)), 0
    while len(live):
        out[live] = mix64(out[live] * np.uint64(0x9E3779B97F4A7C15) + h[start[live] + k])
        k += 1
        live = live[end[live] - start[live] > k]
    return out


def compared(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, position in its row, words) of every compared line."""
    raw, off = text_bytes(col)
    data = np.frombuffer(raw.tobytes().translate(ALNUM), np.uint8)
    starts, ends, _ = word_spans(data, off)
    z = np.zeros(0, np.int64)
    if not len(starts):
        return z, z.astype(np.uint64), z, z
    cut = np.zeros(len(raw) + 1, bool)
    cut[off] = True
    cut[np.flatnonzero(raw == 10) + 1] = True
    line_of = np.searchsorted(np.flatnonzero(cut), starts, side="right")
    first = np.flatnonzero(np.r_[True, line_of[1:] != line_of[:-1]])
    words = np.diff(np.r_[first, len(starts)])
    h = hash_spans(data, starts, ends)
    place_in = np.arange(len(h)) - np.repeat(first, words)
    h = mix64(np.add.reduceat(mix64(h + place_in.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), first))
    row = np.searchsorted(off, starts[first], side="right") - 1
    key = mix64(h ^ mix64(row.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = np.r_[False, key[order][1:] == key[order][:-1]]
    at = np.arange(len(key))
    label = np.zeros(len(key), np.uint64)
    label[order] = (at - np.maximum.accumulate(np.where(same, 0, at))).astype(np.uint64)
    h = np.where(label > 0, mix64(h + label), h)
    new = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    pos = at - np.repeat(new, np.diff(np.r_[new, len(row)]))
    return row, h, pos, words


def aligned(own: list[int], other: list[int]) -> list[int]:
    """Indexes of a longest chain rising in both; ``own`` is ascending and both are distinct."""
    tails: list[int] = []
    ends: list[int] = []
    back = [-1] * len(other)
    for k, p in enumerate(other):
        at = bisect_left(tails, p)
        tails[at:at + 1] = [p]
        ends[at:at + 1] = [k]
        back[k] = ends[at - 1] if at else -1
    out = []
    k = ends[-1] if ends else -1
    while k >= 0:
        out.append(k)
        k = back[k]
    return out[::-1]


def doomed(pairs: list[dict], block_words: int) -> list[int]:
    """Positions of the aligned blocks of ``block_words`` words or more."""
    pairs = sorted(pairs, key=lambda p: p["pos"])
    chain = [pairs[k] for k in aligned([p["pos"] for p in pairs], [p["at"] for p in pairs])]
    out: list[int] = []
    block: list[dict] = []
    for p in [*chain, None]:
        if block and (p is None or p["pos"] != block[-1]["pos"] + 1 or p["at"] != block[-1]["at"] + 1):
            if sum(x["words"] for x in block) >= block_words:
                out += [x["pos"] for x in block]
            block = []
        if p is not None:
            block.append(p)
    return out


def line_pairs(links: list[dict]) -> list[dict]:
    """The distinct pairs of lines of linked lines and runs."""
    found = {(x["pos"] + k, x["at"] + k): w for x in links for k, w in enumerate(x["words"])}
    return [{"pos": p, "at": q, "words": w} for (p, q), w in found.items()]


def deletions(rows: DataFrame, rare: int = RARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, node, gone) for each document of (id, node, text) that loses lines: the
    positions of its deleted lines."""
    lines = written(line_table(rows, block_words), "lines")
    held = lines.groupBy("h").agg(F.count(F.lit(1)).alias("df"), F.min(F.struct("id", "node", "pos")).alias("first")).filter("df > 1")
    held = written(held, "held")  # so that the join deals both sides out itself and a hot line's side can be split
    later = lines.join(held, "h").filter(~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("node") == F.col("first.node"))))
    met = later.groupBy("id", "node", F.col("first.id").alias("first_id"), F.col("first.node").alias("first_node")).agg(
        F.min("df").alias("df"), F.collect_set(F.struct("pos", F.col("first.pos").alias("at"), "words")).alias("links"))
    words = F.col("links")[0]["words"]
    alone = (F.size("links") == 1) & (F.size(words) == 1) & (words[0] < block_words)
    met = met.filter((F.col("df") <= rare) | ~alone)

    def run(batches):
        for b in batches:
            gone = [doomed(line_pairs(x), block_words) for x in b.column("links").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("node"), pa.array(gone, pa.list_(pa.int32()))], names=["id", "node", "gone"])

    kind = rows.schema["id"].dataType.simpleString()
    found = met.select("id", "node", "links").mapInArrow(run, f"id {kind}, node long, gone array<int>")
    return found.filter(F.size("gone") > 0).groupBy("id", "node").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))


def without(text: str, gone: list[int]) -> str:
    """``text`` without the compared lines at the positions ``gone``."""
    lost, out, at = set(gone), [], 0
    for line in text.split("\n"):
        if line.encode().translate(ALNUM).strip(b" "):
            at += 1
            if at - 1 in lost:
                continue
        out.append(line)
    return "\n".join(out)


def dedupe_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare: int = RARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with the text after deletion, and ``n_gone``, its number of deleted lines."""
    plain = positional(docs)
    own, text = place(docs, id_col), place(docs, text_col)
    rows = plain.select(F.col(own).alias("id"), F.xxhash64(F.col(text)).alias("node"), F.col(text).cast("string").alias("text"))
    gone = deletions(rows, rare, block_words).select(F.col("id").alias("_id"), F.col("node").alias("_node"), "gone")
    found = plain.join(gone, F.col(own).eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(text)) == F.col("_node")), "left").drop("_id", "_node")
    cut = len(docs.columns)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            cols = b.columns[:cut]
            gone, texts = b.column(cut).to_pylist(), b.column(at).to_pylist()
            cols[at] = pa.array([without(t, g) if g and t is not None else t for t, g in zip(texts, gone, strict=True)], b.column(at).type)
            yield pa.RecordBatch.from_arrays([*cols, pa.array([len(g or []) for g in gone], pa.int64())], names=[*b.schema.names[:cut], "n_gone"])

    return found.mapInArrow(run, found.drop("gone").withColumn("n_gone", F.lit(0).cast("long")).schema).toDF(*docs.columns, "n_gone")


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_lines (compared lines left), n_gone, text_sha256 of what is left."""
    left = dedupe_lines(docs.select(id_col, text_col), id_col, text_col)
    split = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda x: x.rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]"))
    return left.select(id_col, F.size(split).cast("long").alias("n_lines"), "n_gone", F.sha2(F.col(text_col).cast("binary"), 256).alias("text_sha256"))

"""Benchmark decontamination over a positional inverted index.

``build_index`` stores the training tokens' postings as segments: a segment
holds the documents of some hundred thousand consecutive words, its terms as sorted
64-bit hashes, and per term the sorted positions of its occurrences.
``search`` answers test windows inside each segment: the posting lists of a
window's terms are shifted by the terms' offsets and intersected, starting
from the window's rarest term in that segment, so a window one of whose terms
is missing costs one lookup. Segments are independent: a frequent term's
postings are spread over all of them and nothing is shuffled.

An exact phrase match has every term at its offset. A proximity match allows
each term to be up to ``slop`` words off its place relative to the rarest
term, inside one document.

Words: A-Z is lower-cased, then runs of digits, a-z and non-ASCII characters.
A window is ``width`` consecutive words of an item; an item of fewer words is
one window; an item without words, or a null text, has none. An item with a
null id marks words but is not listed. Documents with a null or empty text
have no words and are never contaminated; rows with equal ids are separate
documents, each with its own result; other columns of the input are ignored. No
documents give an empty result, no benchmark leaves every document clean.
Terms are compared by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ALNUM, hash_spans, positional, slices, text_bytes, word_spans, written
from quire.session import small_batches

WIDTH = 13
SLOP = 3
#: The benchmark is read and sent in blocks of items of about this many bytes.
BLOCK_BYTES = 16 << 20
#: Text of a segment. A segment is a row of the index with several bytes for each of them, and
#: writers, readers and Python workers hold some rows at once.
SEGMENT_BYTES = 1 << 20
#: Row groups of the index, in bytes; a reader holds a whole one.
GROUP_BYTES = 8 << 20

INDEX_SCHEMA = ("doc_ids array<string>, doc_starts array<int>, terms array<long>, "
                "term_starts array<int>, postings array<int>")


class Windows(NamedTuple):
    """Test windows: their distinct terms, ascending, and by width the places of every
    window's terms among them and its item."""
    terms: np.ndarray
    by_width: dict[int, tuple[np.ndarray, np.ndarray]]


class Segment:
    """Postings of some documents. Positions count the words of all of them."""

    def __init__(self, doc_starts: np.ndarray, terms: np.ndarray, term_starts: np.ndarray, postings: np.ndarray):
        self.doc_starts, self.terms, self.term_starts, self.postings = doc_starts, terms, term_starts, postings

    @classmethod
    def of(cls, hashes: np.ndarray, doc_starts: np.ndarray) -> "Segment":
        order = np.argsort(hashes, kind="stable").astype(np.int32)
        by_term = hashes[order]
        first = np.flatnonzero(np.r_[True, by_term[1:] != by_term[:-1]]) if len(by_term) else np.zeros(0, np.int64)
        return cls(doc_starts, by_term[first], np.r_[first, len(by_term)].astype(np.int32), order)

    def lists(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end of each term's postings; equal where the term is absent."""
        if len(self.terms) == 0:
            z = np.zeros(hashes.shape, np.int64)
            return z, z
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        there = self.terms[at] == hashes
        lo = np.where(there, self.term_starts[at], 0)
        return lo, np.where(there, self.term_starts[at + 1], 0)

    def doc_of(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_starts, pos, side="right") - 1

    def intersect(self, lo, hi, order, start: np.ndarray, slop: int) -> np.ndarray:
        """Of the window starts in ``start`` (columns: start, first and end position of
        the document), those with every term of ``order`` within ``slop`` of its
        place and inside the document."""
        for j in order:
            if not len(start):
                break
            want = start[:, 0] + j
            own = self.postings[lo[j]:hi[j]]
            at = np.searchsorted(own, np.maximum(want - slop, start[:, 1]))
            ok = at < len(own)
            ok[ok] = own[at[ok]] <= np.minimum(want + slop, start[:, 2] - 1)[ok]
            start = start[ok]
        return start

    def matches(self, windows: Windows, slop: int):
        """Yields (window's item, width, starts of exact matches, anchors of proximity
        matches); the anchor is the position of the window's rarest term."""
        first, end = self.lists(windows.terms)  # a term of many windows is looked up once
        there = end > first
        for width, (at, items) in windows.by_width.items():
            for w in np.flatnonzero(there[at].all(axis=1)):
                lo, hi = first[at[w]], end[at[w]]
                order = np.argsort(hi - lo, kind="stable")
                rare = int(order[0])
                anchor = self.postings[lo[rare]:hi[rare]].astype(np.int64)
                doc = self.doc_of(anchor)
                start = np.stack([anchor - rare, self.doc_starts[doc], self.doc_starts[doc + 1]], axis=1)
                near = self.intersect(lo, hi, order[1:], start, slop)
                if not len(near):
                    continue
                exact = near[(near[:, 0] >= near[:, 1]) & (near[:, 0] + width <= near[:, 2])]
                exact = self.intersect(lo, hi, order[1:], exact, 0) if slop else exact
                yield items[w], width, exact[:, 0], near[:, 0] + rare


def segments_of(col: pa.Array, limit: int) -> Iterator[tuple[int, int, Segment]]:
    """(first row, end row, segment) of a text column in pieces of ``limit`` bytes."""
    for first, end in slices(col, limit):
        data, off = text_bytes(col.slice(first, end - first), ALNUM)
        starts, ends, before = word_spans(data, off)
        yield first, end, Segment.of(hash_spans(data, starts, ends), before.astype(np.int32))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The documents' positional index as a table of segments (see ``INDEX_SCHEMA``)."""

    def build(batches):
        for b in batches:
            for first, end, s in segments_of(b.column(1), segment_bytes):
                yield pa.RecordBatch.from_arrays([
                    pa.array([b.column(0).slice(first, end - first)], pa.list_(pa.string())),
                    pa.array([s.doc_starts], pa.list_(pa.int32())), pa.array([s.terms.view(np.int64)], pa.list_(pa.int64())),
                    pa.array([s.term_starts], pa.list_(pa.int32())), pa.array([s.postings], pa.list_(pa.int32())),
                ], names=["doc_ids", "doc_starts", "terms", "term_starts", "postings"])

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(build, INDEX_SCHEMA)


def written_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index as a table in the shared folder, in small row groups."""
    return written(build_index(docs, id_col, text_col), "postings",
                   **{"parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1})


def item_windows(rows, width: int) -> Windows:
    """The windows of (item_id, text) pairs."""
    out: dict[int, tuple[list, list]] = {}
    for item, text in rows:
        data, off = text_bytes(pa.array([text], pa.string()), ALNUM)
        starts, ends, _ = word_spans(data, off)
        h = hash_spans(data, starts, ends)
        if len(h) == 0:
            continue
        w = min(width, len(h))
        own = out.setdefault(w, ([], []))
        grams = np.lib.stride_tricks.sliding_window_view(h, w)
        own[0].append(grams)
        own[1].extend([item] * len(grams))
    terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.unique(g) for own, _ in out.values() for g in own)]))
    return Windows(terms, {w: (np.concatenate([np.searchsorted(terms, g).astype(np.int32) for g in own]), np.array(i, object)) for w, (own, i) in out.items()})


def send_windows(benchmark: DataFrame, width: int, item_col: str, text_col: str, block_bytes: int) -> list:
    """Broadcast blocks of test windows. The test items are the stated query set:
    blocks are formed by item hash so that each is bounded, and the driver
    holds one at a time."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    sc = benchmark.sparkSession.sparkContext
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [sc.broadcast(item_windows(map(tuple, rows.filter(block == i).collect()), width)) for i in range(n)]


def mark(segment: Segment, blocks: list, slop: int):
    """Hit words, and per document the items with exact and with proximity matches."""
    n = len(segment.doc_starts) - 1
    edge = np.zeros(int(segment.doc_starts[-1]) + 1, np.int64)
    exact_items: list[set] = [set() for _ in range(n)]
    near_items: list[set] = [set() for _ in range(n)]
    for b in blocks:
        for item, width, exact, near in segment.matches(b.value, slop):
            np.add.at(edge, exact, 1)
            np.add.at(edge, exact + width, -1)
            if item is not None:
                for d in np.unique(segment.doc_of(exact)):
                    exact_items[d].add(item)
                for d in np.unique(segment.doc_of(near)):
                    near_items[d].add(item)
    hits = np.r_[0, np.cumsum(np.cumsum(edge[:-1]) > 0)]
    return hits[segment.doc_starts[1:]] - hits[segment.doc_starts[:-1]], exact_items, near_items


def search(index: DataFrame, benchmark: DataFrame, width: int = WIDTH, slop: int = SLOP,
           item_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per indexed document: id, n_words, n_hit (words inside an exact match),
    items and near_items (sorted ids of items with an exact, a proximity match)."""
    blocks = send_windows(benchmark, width, item_col, text_col, block_bytes)

    def run(batches):
        for b in batches:
            cols = [b.column(i) for i in range(5)]
            for r in range(b.num_rows):
                starts, terms, term_starts, postings = (c[r].values.to_numpy(zero_copy_only=False) for c in cols[1:])
                s = Segment(starts, terms.view(np.uint64), term_starts, postings)
                n_hit, exact, near = mark(s, blocks, slop)
                yield pa.RecordBatch.from_arrays([
                    cols[0][r].values, pa.array(np.diff(starts).astype(np.int64)), pa.array(n_hit.astype(np.int64)),
                    pa.array([sorted(x) for x in exact], pa.list_(pa.string())),
                    pa.array([sorted(x) for x in near], pa.list_(pa.string())),
                ], names=["id", "n_words", "n_hit", "items", "near_items"])

    return index.mapInArrow(run, "id string, n_words long, n_hit long, items array<string>, near_items array<string>")


def contaminated():
    """At least a twentieth of the words lies inside exact matches."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, text_col: str = "text",
                  item_col: str = "item_id", bench_text_col: str = "text",
                  segment_bytes: int = SEGMENT_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the contaminated rows, all columns kept. The segments are
    built and searched batch by batch, so whole rows pass through one scan."""
    blocks = send_windows(benchmark, width, item_col, bench_text_col, block_bytes)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            for first, end, s in segments_of(b.column(at), segment_bytes):
                n_hit, _, _ = mark(s, blocks, 0)
                keep = ~((n_hit > 0) & (20 * n_hit >= np.diff(s.doc_starts)))
                yield b.slice(first, end - first).filter(pa.array(keep))

    plain = positional(docs)
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def contamination_report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Index the documents in the shared folder, search the benchmark, and return per
    document: id, n_words, n_hit, n_items, n_near, items_sha256, contaminated."""
    with small_batches(docs.sparkSession):
        found = written(search(written_index(docs, id_col), benchmark), "found")
    return found.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"), F.size("near_items").cast("long").alias("n_near"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))

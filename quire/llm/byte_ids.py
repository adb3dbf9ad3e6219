"""Token ids as frequency-ranked, byte-aligned variable-length binary segments.

All documents are tokenized once, into a table of ids in the shared folder. The
ids are ranked by how often they occur (one partial count per task over the
vocabulary), so that the frequent ones take one byte.
A segment stores the documents of some megabytes of text in id order: an id's
rank takes one to four bytes in the data stream, and its length in two bits of
a separate control stream, four ids a control byte. Decoding looks every
control byte up in a table of four lengths; their running sum gives each id's
place in the data.

Segments are rows of a Parquet table in the shared folder (``control`` and
``data`` are binary), so any file system Spark knows can hold them; the rank
table is written beside them. Documents are dealt out by ranges of their id,
every task writes its range in order and knows how many ids it wrote before
each segment; the start of a task's first id is a running sum over one row a
task. Nothing passes through one task or the driver but that and the rank
table, which has one row per id of the vocabulary.

A tokenizer that drops white space gives the same ids for a text as for its
white-space-separated pieces one after the other, so each Python worker asks
the tokenizers library once for each distinct piece it meets, and remembers it.

A null or empty text is the end id alone. Documents with equal ids are ordered
by a hash of their text, null ids come first; repeated rows are written as
often as they occur. An empty table writes no segment. Other columns are ignored.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.common import SPACED, give_back, hash_spans, slices, text_bytes, word_spans, written
from quire.session import small_batches

END_ID = 2
#: Bytes of remembered pieces a Python worker holds before it starts anew; with a third of
#: it, pieces are forgotten too soon and tokenized again and again.
CACHE_BYTES = 48 << 20
#: Ids in a segment, as they are between tokenizing and coding: some megabytes of text.
SEGMENT_BYTES = 1 << 20
#: Text tokenized, or ids counted, at once.
TEXT_BYTES = 1 << 20
#: New pieces that the tokenizer is asked for at once: it keeps texts, offsets and masks of each.
NEW_PIECES = 2048
#: Lengths of the four ids of a control byte.
LENGTHS = np.stack([(np.arange(256) >> s & 3) + 1 for s in (0, 2, 4, 6)], axis=1).astype(np.int64)


class Pieces:
    """Ids of white-space-separated pieces by a tokenizers file, remembered by piece
    in sorted arrays."""

    _known: dict[str, "Pieces"] = {}

    @classmethod
    def of(cls, path: str) -> "Pieces":
        """The one of this Python worker: what earlier tasks asked for is still known."""
        if path not in cls._known:
            cls._known[path] = cls(path)
        return cls._known[path]

    @classmethod
    def forget(cls) -> None:
        """Nothing is tokenized any more: a worker of the later stages lets its pieces go."""
        cls._known.clear()
        give_back()

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self):
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.first, self.ids = np.zeros(1, np.int32), np.zeros(0, np.uint32)

    def learn(self, h: np.ndarray, pieces: list[str]) -> None:
        found = []
        for lo in range(0, len(pieces), NEW_PIECES):
            found += [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(pieces[lo:lo + NEW_PIECES], add_special_tokens=False)]
        at = np.searchsorted(self.keys, h)
        self.keys = np.insert(self.keys, at, h)
        self.slots = np.insert(self.slots, at, len(self.first) - 1 + np.arange(len(h), dtype=np.int32))
        self.first = np.r_[self.first, self.first[-1] + np.cumsum([len(x) for x in found], dtype=np.int32)]
        self.ids = np.concatenate([self.ids, *found])

    def __call__(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, ids of each row) of a text column."""
        if self.keys.nbytes + self.slots.nbytes + self.first.nbytes + self.ids.nbytes > CACHE_BYTES:
            self.clear()
        raw, off = text_bytes(col)
        text = raw.tobytes()
        starts, ends, before = word_spans(np.frombuffer(text.translate(SPACED), np.uint8), off)
        h, at, piece = np.unique(hash_spans(raw, starts, ends), return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.keys, h), max(len(self.keys) - 1, 0))
        new = np.flatnonzero(self.keys[place] != h) if len(self.keys) else np.arange(len(h))
        if len(new):
            self.learn(h[new], [text[a:b].decode() for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)])
        slot = self.slots[np.searchsorted(self.keys, h)][piece]
        first, n = self.first[slot], self.first[slot + 1] - self.first[slot]
        total = np.r_[0, np.cumsum(n)]
        return self.ids[np.repeat(first - total[:-1], n) + np.arange(total[-1])], np.diff(total[before])


def with_end(ids: np.ndarray, n: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, np.cumsum(n), end_id), n + 1


def encode(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit ranks."""
    ranks = ranks.astype("<u4")
    extra = (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    four = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    four[:len(ranks)] = extra
    four = four.reshape(-1, 4)
    return (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks of a segment."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(size) - size
    src = np.frombuffer(data, np.uint8)
    out = src[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        out[more] |= src[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def tokenize(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(id, tie, ids) of every document: its ids with the end id as little-endian unsigned
    integers (see ``width``), and a hash of the text that orders rows of equal id."""
    kind = width(vocabulary_size(path, end_id))

    def run(batches):
        pieces = Pieces.of(path)
        for b in batches:
            for first, end in slices(b.column(2), TEXT_BYTES):
                ids, n = with_end(*pieces(b.column(2).slice(first, end - first)), end_id)
                cut = np.r_[0, np.cumsum(n)] * np.dtype(kind).itemsize
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(ids.astype(kind))])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, end - first), b.column(1).slice(first, end - first), raw.cast(pa.binary())],
                                                 names=["id", "tie", "ids"])
        give_back()

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).cast("string").alias("text"))
    id_kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_kind}, tie long, ids binary")


def vocabulary_size(path: str, end_id: int) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1)


def width(size: int) -> str:
    """Integer type of the ids of a vocabulary between tokenizing and coding."""
    return "<u2" if size <= 1 << 16 else "<u4"


def raw_ids(col: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, ids of each row) of an ``ids`` column."""
    raw, off = text_bytes(col)
    return raw.view(kind), np.diff(off) // np.dtype(kind).itemsize


def rank_table(tokenized: DataFrame, size: int) -> DataFrame:
    """(rank, id) of the ``size`` ids of the vocabulary, the most frequent first; ties by id."""

    def count(batches):
        Pieces.forget()
        total = np.zeros(size, np.int64)
        for b in batches:
            for first, end in slices(b.column(0), TEXT_BYTES):
                total += np.bincount(raw_ids(b.column(0).slice(first, end - first), width(size))[0], minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": seen.astype(np.int64), "n": total[seen]})

    counts = tokenized.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    every = tokenized.sparkSession.range(size).join(counts, "id", "left")
    return every.select((F.row_number().over(W.orderBy(F.col("n").desc_nulls_last(), "id")) - 1).cast("long").alias("rank"), "id")


def write_ids(docs: DataFrame, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Write all documents; returns the segment table (part, seq, before, doc_ids, n_ids,
    control, data) and the rank table, both as read from the shared folder."""
    size = vocabulary_size(path, end_id)
    with small_batches(docs.sparkSession):
        tokenized = written(tokenize(docs, path, end_id, id_col, text_col), "tokenized", compression="zstd")
        ranks = written(rank_table(tokenized, size), "id-ranks")
    id_of = ranks.orderBy("rank").toArrow()["id"].to_numpy()
    rank_of = np.empty(len(id_of), np.uint32)
    rank_of[id_of] = np.arange(len(id_of), dtype=np.uint32)
    sent = docs.sparkSession.sparkContext.broadcast(rank_of)

    def write(batches):
        Pieces.forget()
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            for first, end in slices(b.column(1), SEGMENT_BYTES):
                ids, n = raw_ids(b.column(1).slice(first, end - first), width(size))
                control, data = encode(sent.value[ids])
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([before], pa.int64()),
                    pa.array([b.column(0).slice(first, end - first).to_pylist()], pa.list_(b.column(0).type)), pa.array([n], pa.list_(pa.int64())),
                    pa.array([control], pa.binary()), pa.array([data], pa.binary())], names=["part", "seq", "before", "doc_ids", "n_ids", "control", "data"])
                seq, before = seq + 1, before + len(ids)
        give_back()

    order = [F.col("id").asc_nulls_first(), F.col("tie")]
    kind = tokenized.schema["id"].dataType.simpleString()
    segments = tokenized.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "ids").mapInArrow(
        write, f"part int, seq long, before long, doc_ids array<{kind}>, n_ids array<long>, control binary, data binary")
    with small_batches(docs.sparkSession):
        return written(segments, "ids", compression="zstd"), ranks


def read_ids(segments: DataFrame, ranks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document, decoded from the segments: id, start, n_tokens, ids_crc32."""
    id_of = ranks.orderBy("rank").toArrow()["id"].to_numpy().astype("<u4")
    sent = segments.sparkSession.sparkContext.broadcast(id_of)

    def read(batches):
        for b in batches:
            for r in range(b.num_rows):
                part, before, doc_ids, n, control, data = (b.column(k)[r] for k in ("part", "before", "doc_ids", "n_ids", "control", "data"))
                n = n.values.to_numpy()
                end = np.cumsum(n)
                ids = sent.value[decode(control.as_py(), data.as_py(), int(end[-1]))]
                crc = [zlib.crc32(ids[e - k:e].tobytes()) for e, k in zip(end.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    doc_ids.values, pa.array(np.full(len(n), part.as_py(), np.int32)), pa.array(before.as_py() + end - n), pa.array(n),
                    pa.array(crc, pa.int64())], names=["id", "part", "at", "n_tokens", "ids_crc32"])
        give_back()

    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    with small_batches(segments.sparkSession):
        rows = written(segments.mapInArrow(read, f"id {kind}, part int, at long, n_tokens long, ids_crc32 long"), "id-rows")
    per = segments.select("part", F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    first = per.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("first"))
    # one row per task that wrote: as many as the job had partitions
    return rows.join(F.broadcast(first), "part").select(F.col("id").alias(id_col), (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(docs: DataFrame, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the documents' ids and return what the files hold."""
    return read_ids(*write_ids(docs, path, end_id, id_col, text_col), id_col)

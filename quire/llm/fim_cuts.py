"""Fill-in-middle transformation over a Roaring-style set of cut offsets.

A text is cut into units, its lines (a line keeps its line feed). The ends of
all units of a slice of texts are one ascending set of byte offsets, held as a
compressed bitmap: 2^16 offsets share a container, which is a sorted array, a
bitmap or a list of runs, whichever is smallest, and the containers' running
cardinalities stand beside them. The offset after k units of a text is the
set's select of (units of earlier texts + k - 1): a search in the running
cardinalities names the container, a select inside it the offset. Both cuts of
every text of a slice are found by one such call.

The cuts are drawn from the sha256 of ``<seed>:<id>``, so reruns and lost
executors give the same rows. The form is ``psm`` (prefix, suffix, middle) or
``spm`` (suffix, prefix, middle), each part behind its mark; a text that is
empty or holds a mark, or that the rate leaves out, stays ``plain``. ``restore``
rebuilds the text from output and form alone.

A null text counts as empty: no units, form plain, output ''. A null id draws
from ``<seed>:``. Equal rows give equal results, an empty table an empty one.
All columns of the input are kept under their own names, in front of the new
ones, and none of their names matters; ``restore`` reads the last two.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import place, positional, slices, text_bytes

SEED = 7
#: Of 100 texts, how many are transformed, and how many of those take the spm form.
RATE, SPM_RATE = 100, 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ADDED = [("n", "long"), ("prefix_chars", "long"), ("middle_chars", "long"), ("form", "string"), ("output", "string")]

ARRAY, BITMAP, RUN = 0, 1, 2
CONTAINER_BITS = 16
#: Bytes of a container's bitmap.
BITMAP_BYTES = (1 << CONTAINER_BITS) // 8


class Container(NamedTuple):
    """Offsets that share their high bits ``key``; ``size`` of them.

    ``ARRAY``: ``data`` holds the low 16 bits, ascending. ``BITMAP``: ``data`` is the
    bitmap's bytes and ``rank`` the set bits before each byte. ``RUN``: ``data`` holds
    the first value of each run and ``rank`` the values before it.
    """
    kind: int
    key: int
    size: int
    data: np.ndarray
    rank: np.ndarray | None = None


#: Place of the r-th set bit (least bit first) of each byte.
SELECT_IN_BYTE = np.zeros((256, 8), np.int64)
for _byte in range(256):
    for _r, _bit in enumerate(b for b in range(8) if _byte >> b & 1):
        SELECT_IN_BYTE[_byte, _r] = _bit


def container(key: int, low: np.ndarray) -> Container:
    """The smallest form of an ascending set of 16-bit values."""
    first = np.flatnonzero(np.r_[True, np.diff(low) != 1])
    size = {ARRAY: 2 * len(low), BITMAP: BITMAP_BYTES, RUN: 4 * len(first)}
    kind = min(size, key=size.get)
    if kind == ARRAY:
        return Container(ARRAY, key, len(low), low.astype(np.uint16))
    if kind == RUN:
        return Container(RUN, key, len(low), low[first].astype(np.uint16), first)
    bits = np.zeros(1 << CONTAINER_BITS, np.uint8)
    bits[low] = 1
    data = np.packbits(bits, bitorder="little")
    rank = np.cumsum(np.bitwise_count(data), dtype=np.int64) - np.bitwise_count(data)
    return Container(BITMAP, key, len(low), data, rank)


def select_in(c: Container, r: np.ndarray) -> np.ndarray:
    """The values of the given ranks of one container."""
    if c.kind == ARRAY:
        return c.data[r].astype(np.int64)
    at = np.searchsorted(c.rank, r, side="right") - 1
    if c.kind == RUN:
        return c.data[at].astype(np.int64) + r - c.rank[at]
    return at * 8 + SELECT_IN_BYTE[c.data[at], r - c.rank[at]]


class BoundarySet:
    """An ascending set of offsets in containers with running cardinalities."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> CONTAINER_BITS
        cut = np.r_[np.flatnonzero(np.r_[True, np.diff(high) != 0]), len(offsets)] if len(offsets) else np.zeros(1, np.int64)
        self.containers = [container(int(high[a]), offsets[a:b] & (1 << CONTAINER_BITS) - 1) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        #: Offsets before each container; the last entry is the set's size.
        self.before = np.r_[0, np.cumsum([c.size for c in self.containers])].astype(np.int64)

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The offsets of the given ranks, 0 for the least."""
        ranks = np.asarray(ranks, np.int64)
        out = np.empty(len(ranks), np.int64)
        of = np.searchsorted(self.before, ranks, side="right") - 1
        order = np.argsort(of, kind="stable")
        cut = np.searchsorted(of[order], np.arange(len(self.containers) + 1))
        for k in np.unique(of).tolist():
            c, own = self.containers[k], order[cut[k]:cut[k + 1]]
            out[own] = (c.key << CONTAINER_BITS) + select_in(c, ranks[own] - self.before[k])
        return out


def unit_ends(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end of every unit of the slice, units before each row; one more than rows)."""
    last = np.zeros(len(data) + 1, bool)
    last[np.flatnonzero(data == 10) + 1] = True
    last[off[1:][np.diff(off) > 0]] = True  # a last line without a line feed; no row ends inside another
    ends = np.flatnonzero(last)
    return ends, np.searchsorted(ends, off, side="right")


def code_points_before(data: np.ndarray) -> np.ndarray:
    """Code points that start before each byte offset (UTF-8)."""
    return np.r_[0, np.cumsum((data & 0xC0) != 0x80)]


def cuts(data: np.ndarray, off: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(units, end of the prefix, end of the middle) of each row of a slice; the ends are
    byte offsets into the slice. ``draws`` has the two numbers drawn for each row."""
    ends, before = unit_ends(data, off)
    n = np.diff(before)
    units = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    found = np.repeat(off[:-1, None], 2, axis=1)
    row, side = np.nonzero(units)
    found[row, side] = BoundarySet(ends).select(before[row] + units[row, side] - 1)
    return n, found[:, 0], found[:, 1]


def draws(seed: int, id_col: Column) -> list[Column]:
    """Four unsigned 32-bit numbers of the id: the leading digits of sha256('<seed>:<id>')."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """``docs`` with n (units), prefix_chars, middle_chars (code points; null if plain),
    form and output."""
    plain = positional(docs)
    width = len(docs.columns)
    own, text = plain[place(docs, id_col)], docs.columns.index(text_col)
    h = draws(seed, own)
    marked = F.coalesce(plain[f"c{text}"].cast("string"), F.lit(""))
    chosen = (marked != "") & (h[2] % 100 < rate)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        chosen = chosen & ~marked.contains(mark)
    rows = plain.select(*plain.columns, h[0].alias("h1"), h[1].alias("h2"),
                        F.when(~chosen, "plain").when(h[3] % 100 < spm_rate, "spm").otherwise("psm").alias("form"))
    names = [*plain.columns, *(x for x, _ in ADDED)]
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def outputs(texts: bytes, off: list[int], one: list[int], two: list[int], forms: list[str]) -> list[bytes]:
        out = []
        for a, i, j, b, form in zip(off[:-1], one, two, off[1:], forms, strict=True):
            if form == "plain":
                out.append(texts[a:b])
            elif form == "psm":
                out.append(b"".join((p, texts[a:i], s, texts[j:b], m, texts[i:j])))
            else:
                out.append(b"".join((s, texts[j:b], p, texts[a:i], m, texts[i:j])))
        return out

    def run(batches):
        for b in batches:
            strings = b.column(text).cast(pa.string())
            for first, end in slices(strings):
                part = b.slice(first, end - first)
                data, off = text_bytes(strings.slice(first, end - first))
                drawn = np.stack([part.column(width + k).to_numpy() for k in (0, 1)], axis=1)
                n, one, two = cuts(data, off, drawn)
                before = code_points_before(data)
                forms = part.column(width + 2).to_pylist()
                none = np.array([f == "plain" for f in forms])
                out = outputs(data.tobytes(), off.tolist(), one.tolist(), two.tolist(), forms)
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:width], pa.array(n), pa.array(before[one] - before[off[:-1]], mask=none), pa.array(before[two] - before[one], mask=none),
                    part.column(width + 2), pa.array(out, pa.binary()).cast(pa.string())], names=names)

    schema = T.StructType([*plain.schema.fields, *(T.StructField(x, T.StringType() if k == "string" else T.LongType()) for x, k in ADDED)])
    return rows.mapInArrow(run, schema).toDF(*docs.columns, *(x for x, _ in ADDED))


def restored(form: Column, output: Column) -> Column:
    """The text that ``output`` was made from."""
    def between(first: str, last: str) -> Column:
        after = F.substring_index(output, first, -1)
        return F.substring_index(after, last, 1) if last else after

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, ""), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, ""), between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def restore(transformed: DataFrame) -> DataFrame:
    """``transformed`` (its last two columns are form and output) with the text rebuilt, as
    its new last column ``restored``."""
    plain = positional(transformed)
    form, output = (plain[f"c{len(plain.columns) - k}"] for k in (2, 1))
    return plain.select("*", restored(form, output).alias("restored")).toDF(*transformed.columns, "restored")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    back = restore(transform(docs.select(id_col, text_col), id_col, text_col))
    return back.select(id_col, "n", "form", "prefix_chars", "middle_chars",
                       *[F.sha2(F.col(x).cast("binary"), 256).alias(f"{x}_sha256") for x in ("output", "restored")])

"""Helpers shared by the training-data operators.

Text reaches Python in Arrow batches. The helpers work on the batch's own
byte buffer with numpy, so no per-word Python object is made; a batch is cut
into slices of bounded bytes first, so memory does not follow the batch.
"""

from __future__ import annotations

import ctypes
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.session import checkpoint_dir

SLICE_BYTES = 2 << 20
#: Cells of a dense table of trigrams; larger alphabets are sorted instead.
DENSE_CELLS = 1 << 20


def written(df: DataFrame, name: str, compression: str = "snappy", **options) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder (lineage ends there), written with
    ``options``."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.options(compression=compression, **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def positional(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ...: no name of the input can clash with
    a helper column, hold a dot or appear twice."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def place(df: DataFrame, col: str) -> str:
    return f"c{df.columns.index(col)}"


def give_back() -> None:
    """Free memory of this Python worker goes back to the machine, for the worker lives on in
    the next stages. Beyond Arrow's own that takes glibc; elsewhere that part is left out."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


#: Keys that a counted join sends out, the most frequent first.
HOT_KEYS = 2000


def null_safe(pairs) -> Column:
    """All the pairs of columns are equal, nulls too."""
    return reduce(lambda x, y: x & y, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs])


def join_counted(rows: DataFrame, per_key: DataFrame, keys: list[str], count: str, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``per_key``, which has one row a key and in ``count`` the number of
    rows with that key; null keys are equal, other names must not clash. The ``HOT_KEYS``
    most frequent keys are broadcast, so no key that a shuffle meets has more than one in
    ``HOT_KEYS`` of the rows. ``how`` is inner or left. Both tables are read twice: write
    them first if they are not cheap. The other columns of ``per_key`` come last."""
    names, own = [f"_k{i}" for i in range(len(keys))], [f"_h{i}" for i in range(len(keys))]
    more = [c for c in per_key.columns if c not in keys and c != count]
    small = per_key.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], *more, F.col(count).alias("_n"))
    top = small.orderBy(F.col("_n").desc(), *names).limit(HOT_KEYS).drop("_n")
    hot = rows.sparkSession.createDataFrame(top.toArrow(), top.schema)
    sent = F.broadcast(hot.select(*[F.col(n).alias(h) for n, h in zip(names, own, strict=True)]))
    met = null_safe(zip(keys, names, strict=True))
    rest = rows.join(sent, null_safe(zip(keys, own, strict=True)), "left_anti")
    cold = small.join(sent, null_safe(zip(names, own, strict=True)), "left_anti").drop("_n")
    return rows.join(F.broadcast(hot), met).drop(*names).unionByName(rest.join(cold, met, how).drop(*names))


def fold(id_col: str = "doc_id", mod: int = 5) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod


def byte_table(word: bytes, lower: bool) -> bytes:
    """256-byte translation table: bytes of ``word`` stay (A-Z lower-cased when
    asked), every other byte becomes a space."""
    keep = set(word)
    out = bytearray(b" " * 256)
    for b in range(256):
        c = b + 32 if lower and 65 <= b <= 90 else b
        if c in keep:
            out[b] = c
    return bytes(out)


HIGH = bytes(range(0x80, 0x100))
ALNUM = byte_table(bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + HIGH, lower=True)
_PRINT = bytes(b for b in range(256) if b not in b" \t\n\r\x0b\x0c")
SPACED = byte_table(_PRINT, lower=False)
SPACED_LOWER = byte_table(bytes(b for b in _PRINT if not 65 <= b <= 90), lower=True)


def slices(col: pa.Array, limit: int = SLICE_BYTES):
    """(first, end) row ranges of a string column, each of ``limit`` bytes at most
    unless a single row is longer."""
    off = offsets(col)
    first, n = 0, len(col)
    while first < n:
        end = int(np.searchsorted(off, off[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end
        first = end


def offsets(col: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    buf = col.buffers()[1]
    if buf is None or len(col) == 0:
        return np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(buf, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    return off.astype(np.int64)


def text_bytes(col: pa.Array, table: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, translated by ``table``; null rows are empty."""
    if col.null_count:
        col = col.fill_null("")
    off = offsets(col)
    buf = col.buffers()[2]
    raw = b"" if buf is None else bytes(memoryview(buf)[off[0]:off[-1]])
    if table is not None:
        raw = raw.translate(table)
    return np.frombuffer(raw, np.uint8), off - off[0]


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of non-space bytes) of all rows: starts, ends, and the words
    before each row (length rows + 1). A word never crosses a row's end."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    word = data != 32
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOW = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M2
    x ^= x >> np.uint64(27)
    x *= _M3
    x ^= x >> np.uint64(31)
    return x


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes a step; depends on the bytes alone."""
    lens = ends - starts
    h = lens.astype(np.uint64) * _M1
    if len(lens) == 0:
        return h
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    live, pos, rem = None, starts, lens
    while True:
        x = words[pos] & _LOW[np.minimum(rem, 8)]
        if live is None:
            h = mix64((h ^ x) * _M1)
            live = np.flatnonzero(rem > 8)
        else:
            h[live] = mix64((h[live] ^ x) * _M1)
            live = live[rem > 8]
        if len(live) == 0:
            return h
        done = 8 if pos is starts else done + 8
        pos, rem = starts[live] + done, lens[live] - done


def hash_text(words: list[bytes]) -> np.ndarray:
    """``hash_spans`` of separate byte strings."""
    off = np.cumsum([0] + [len(w) for w in words])
    return hash_spans(np.frombuffer(b"".join(words), np.uint8), off[:-1], off[1:])


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts, each followed by a line feed and the whole led by one, as
    code points; and the position of each text's first code point."""
    texts = [t or "" for t in texts]
    cps = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le"), "<u4").astype(np.int32)
    first = np.cumsum([1] + [len(t) + 1 for t in texts])
    return cps, first


def row_of(texts: list[str | None], first: np.ndarray) -> np.ndarray:
    """The text each code point of ``code_points`` belongs to, with the line feed
    after it; -1 for the leading line feed."""
    return np.r_[-1, np.repeat(np.arange(len(texts)), np.diff(first))]


def compact_trigrams(sym: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct trigrams packed 21 bits a symbol, ascending; index into them) of the
    trigrams of ``sym`` that start where ``ok`` holds. Counts over the symbols in
    use, so nothing is sorted unless the alphabet is large."""
    seen = np.zeros(1 << 21, bool)
    seen[sym] = True
    used = np.flatnonzero(seen)
    k = len(used)
    dense = np.zeros(1 << 21, np.int32)
    dense[used] = np.arange(k)
    x = dense[sym]
    if k ** 3 <= DENSE_CELLS:
        code = ((x[:-2] * k + x[1:-1]) * k + x[2:])[ok]
        known = np.flatnonzero(np.bincount(code, minlength=1))
        place = np.zeros(k ** 3, np.int32)
        place[known] = np.arange(len(known))
        code = place[code]
    else:
        code = ((x[:-2].astype(np.int64) * k + x[1:-1]) * k + x[2:])[ok]
        known, code = np.unique(code, return_inverse=True)
    return (used[known // (k * k)] << 42) | (used[known // k % k] << 21) | used[known % k], code

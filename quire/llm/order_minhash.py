"""Near duplicates by Order MinHash.

A document's k-mers are its five-word shingles, each labelled with its
occurrence number so that repeated shingles count separately. For each of
``TABLES`` hash functions the ``PICKED`` labelled k-mers of least hash are
taken and kept in text order; their hash is the document's key in that table.
Two documents agree in a table when the same k-mers are least in both and stand
in the same order, which follows their edit similarity.

Exact copies are one node from the start. Candidates come in two rounds. In the
first, each node of a bucket is paired with two hubs, the node that shares most
(with the largest buckets over all tables) and the first: as many pairs as
members, not all pairs. Pairs whose sizes rule the threshold out are dropped.

The second round takes the buckets of three nodes or more that the first left in
several classes (pages of one template, versions that are near each other but
not the hub) and loses no pair of them. Their nodes' shingles are ordered by the
number of these nodes that have them, the rarest first; two texts of similarity
s or more share one of the first n - ceil(s n) + 1 of either (they could not
share enough otherwise). Nodes of different classes that meet there are paired.
A shingle of more than ``COMMON`` nodes (a template's) pairs only nodes that
could reach s on such shingles alone; all others must share a rarer one too.
Of these pairs, bit strings of ``BITS`` parities rule out most: two texts differ
in at least as many shingles as their strings differ in bits.

Pairs are verified on the whole texts by banded alignment: labelled shingles
that both have are matched, matches further off the diagonal than the
threshold allows are left out (no alignment at or above it is lost), and the
longest increasing chain of the rest is the aligned part c. The similarity
c / (a + b - c) must be 0.8 or more. Verified pairs join nodes into classes by
alternating large-star and small-star steps on written tables.

At similarity 0.8 a pair agrees in a table with probability of about 0.51, so
16 tables miss it with about 1e-5.

Words are lower-cased runs of digits, a-z and non-ASCII characters; a text of
one to four words is one shingle. A null, empty or wordless text is never a
duplicate and is a class of its own. The class id is the least id of the
class; of rows with equal id and text one stays. Null ids come last and give
a null class id only where the whole class has none. An empty table gives an
empty result; other columns are kept by ``dedupe``, ignored by the report.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.common import ALNUM, hash_spans, mix64, place, positional, slices, text_bytes, word_spans, written

WORDS = 5
TABLES, PICKED = 16, 3
SIMILARITY = 0.8
#: Shingles of more nodes are common: they pair only texts that rarer ones need not pair.
COMMON = 32
SALTS = 16
BITS = 1024
#: Tables of ids up to this many rows (some 150 bytes each in the driver) are broadcast.
BROADCAST_ROWS = 20_000
#: Of larger ones up to this many rows, hashes are broadcast (some 6 bytes a row) and only rows that
#: may meet one are shuffled; beyond that all rows are.
HASHED_ROWS = 2_000_000
#: Hashes of a row of the broadcast table, about.
HASHES = 64
_ODD = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) % (1 << 64) | 1 for k in range(WORDS)], np.uint64)
_SALTS = mix64(np.arange(1, TABLES + 1, dtype=np.uint64)) | np.uint64(1)


def labelled(col: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Per row the hashes of its occurrence-labelled shingles in text order."""
    data, off = text_bytes(col, ALNUM)
    starts, ends, before = word_spans(data, off)
    h = hash_spans(data, starts, ends)
    n = np.diff(before)
    size = np.where(n > 0, np.maximum(n - words + 1, 1), 0)
    cut = np.r_[0, np.cumsum(size)]
    row = np.repeat(np.arange(len(n)), size)
    first = before[row] + np.arange(len(row)) - cut[row]
    shingle = np.zeros(len(row), np.uint64)
    padded = np.r_[h, np.zeros(words, np.uint64)]
    for k in range(words):
        shingle += np.where(k < n[row], padded[first + k], np.uint64(0)) * _ODD[k]
    shingle = mix64(shingle)
    key = mix64(shingle ^ mix64(row.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = np.r_[False, key[order][1:] == key[order][:-1]] if len(key) else np.zeros(0, bool)
    if same.any():
        at = np.arange(len(key))
        label = np.zeros(len(key), np.uint64)
        label[order] = (at - np.maximum.accumulate(np.where(same, 0, at))).astype(np.uint64)
        shingle = np.where(label > 0, mix64(shingle + label * _ODD[0]), shingle)
    return [shingle[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def keys_of(x: np.ndarray) -> np.ndarray:
    """One key per table of a document's labelled shingles."""
    out = np.empty(TABLES, np.uint64)
    step = max(1, min(TABLES, (4 << 20) // max(len(x), 1)))
    for t in range(0, TABLES, step):
        v = x[None, :] * _SALTS[t:t + step, None]
        v ^= v >> np.uint64(32)
        v *= _SALTS[t:t + step, None]
        if len(x) > PICKED:
            at = np.sort(np.argpartition(v, PICKED - 1, axis=1)[:, :PICKED], axis=1)
        else:
            at = np.tile(np.arange(len(x)), (len(v), 1))
        key = np.full(len(v), len(x) if len(x) < PICKED else PICKED, np.uint64)
        for k in range(at.shape[1]):
            key = mix64(key * _ODD[1] + x[at[:, k]])
        out[t:t + step] = key
    return out


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned share of two sequences of distinct labelled shingles; exact where it is
    ``least`` or more, a lower bound otherwise."""
    if not len(a) or not len(b):
        return 0.0
    _, pa_, pb = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    # at ``least``, (a + b)(1 - least) / (1 + least) shingles at most stand alone, and no match is further off
    near = np.abs(pa_ - pb) <= (len(a) + len(b)) * (1 - least) / (1 + least) + 1
    pb = pb[near][np.argsort(pa_[near])]
    if (np.diff(pb) > 0).all():
        c = len(pb)
    else:
        tails: list[int] = []
        for p in pb.tolist():
            at = bisect_left(tails, p)
            tails[at:at + 1] = [p]
        c = len(tails)
    return c / (len(a) + len(b) - c)


def sketches(docs: DataFrame) -> DataFrame:
    """(id, node, n, keys) of rows (id, node, text): number of shingles, keys by table."""

    def run(batches):
        for b in batches:
            for first, end in slices(b.column(2)):
                x = labelled(b.column(2).slice(first, end - first))
                keys = [keys_of(v).view(np.int64) if len(v) else [] for v in x]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, end - first), b.column(1).slice(first, end - first),
                                                  pa.array([len(v) for v in x], pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                                                 names=["id", "node", "n", "keys"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, node binary, n long, keys array<long>")


def buckets(nodes: DataFrame) -> DataFrame:
    """(t, key, num, n, k): the nodes of every bucket of k > 1 nodes."""
    rows = nodes.select("num", "n", F.posexplode("keys").alias("t", "key"))
    crowd = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    return written(rows.join(crowd, ["t", "key"]), "buckets")


def candidates(shared: DataFrame, least: float) -> DataFrame:
    """Distinct pairs (a < b) of node numbers: the members of each bucket with its hubs."""
    weight = shared.groupBy("num").agg(F.sum("k").alias("weight"))
    shared = shared.join(weight, "num")
    hubs = shared.groupBy("t", "key").agg(F.max_by(F.struct("num", "n"), F.struct("weight", -F.col("num"))).alias("hub"),
                                          F.min(F.struct("num", "n")).alias("low"))
    hubs = written(hubs, "hubs")  # so that the join deals a hot bucket's members out itself
    met = shared.select("t", "key", "num", "n").join(hubs, ["t", "key"])
    met = met.select("num", "n", F.explode(F.array("hub", "low")).alias("o")).filter(F.col("num") != F.col("o.num"))
    met = met.filter(F.least("n", "o.n") >= least * F.greatest("n", "o.n"))
    return met.select(F.least("num", "o.num").alias("a"), F.greatest("num", "o.num").alias("b")).distinct()


def unsettled(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """(num, root) of the nodes in buckets of three or more that hold several classes."""
    of = shared.filter("k > 2").select("t", "key", "num").join(roots, "num", "left").withColumn("root", F.coalesce("root", "num"))
    of = written(of, "members")
    open_ = of.groupBy("t", "key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
    open_ = written(open_.select("t", "key"), "open")  # so that the join deals a hot bucket's members out itself
    return of.join(open_, ["t", "key"], "left_semi").select("num", "root").distinct()


def parities(texts: DataFrame) -> DataFrame:
    """(num, bits) of (num, text): for each of ``BITS`` places whether an odd number of
    the text's shingles falls there."""

    def run(batches):
        for b in batches:
            for first, end in slices(b.column(1), 4 << 20):
                own = b.slice(first, end - first)
                odd = [np.packbits((np.bincount((v >> np.uint64(7)).astype(np.int64) % BITS, minlength=BITS) & 1).astype(bool)).view(np.int64)
                       for v in labelled(own.column(1))]
                yield pa.RecordBatch.from_arrays([own.column(0), pa.array(odd, pa.list_(pa.int64()))], names=["num", "bits"])

    return texts.select("num", "text").mapInArrow(run, "num long, bits array<long>")


def rare_pairs(texts: DataFrame, least: float, common: int = COMMON) -> DataFrame:
    """Distinct pairs (a < b) of the rows (num, root, text) with different roots: every
    pair of similarity ``least`` or more is among them."""

    def run(batches):
        for b in batches:
            for first, end in slices(b.column(2), 4 << 20):
                own = b.slice(first, end - first)
                x = labelled(own.column(2))
                n = np.array([len(v) for v in x])
                row = pa.array(np.repeat(np.arange(len(x)), n))
                yield pa.RecordBatch.from_arrays([own.column(0).take(row), own.column(1).take(row), pa.array(np.repeat(n, n)),
                                                  pa.array(np.concatenate(x).view(np.int64))], names=["num", "root", "n", "s"])

    rows = written(texts.select("num", "root", "text").mapInArrow(run, "num long, root long, n long, s long"), "shingles")
    held = written(rows.groupBy("s").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "shared-shingles")
    rows = rows.join(held, "s")
    own = W.partitionBy("num")
    rows = rows.select("*", F.count(F.lit(1)).over(own).alias("met"), F.count_if(F.col("df") > common).over(own).alias("hot"),
                       F.row_number().over(own.orderBy("df", "s")).alias("rank"))
    # shingles of one node stand before all others; 1e-6 guards the ceiling against rounding up
    first = F.col("n") - F.ceil(least * F.col("n") - 1e-6) + 1 - (F.col("n") - F.col("met"))
    rows = written(rows.filter(F.col("rank") <= first).select("num", "root", "n", "s", "df", "hot"), "prefixes")

    def met(own: DataFrame, by: list[str], other: DataFrame) -> DataFrame:
        # never broadcast: a node's rows are alike and small in a file, many times larger in memory
        a, b = own.hint("merge").alias("a"), other.hint("merge").alias("b")
        on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in by]
        fits = F.least("a.n", "b.n") >= least * F.greatest("a.n", "b.n")
        return a.join(b, [*on, F.col("a.num") < F.col("b.num"), F.col("a.root") != F.col("b.root"), fits])

    rarer, hot = rows.filter(F.col("df") <= common), rows.filter(F.col("df") > common)
    bits = written(parities(texts.join(hot.select("num").distinct(), "num", "left_semi")), "parities")
    hot = written(hot.join(bits.hint("merge"), "num"), "hot-prefixes")
    pairs = met(rarer, ["s"], rarer).select("a.num", F.col("b.num").alias("b"))
    # a common shingle's nodes are dealt out in blocks; every pair of blocks meets once
    blocks = hot.withColumn("salt", F.pmod(F.xxhash64("num"), F.lit(SALTS)))
    spread = hot.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    reach = F.least("a.hot", "b.hot") >= least / (1 + least) * (F.col("a.n") + F.col("b.n")) - 1e-6
    apart = F.aggregate(F.zip_with("a.bits", "b.bits", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    reach &= apart <= (1 - least) / (1 + least) * (F.col("a.n") + F.col("b.n")) + 1e-6
    dense = met(blocks, ["s", "salt"], spread).filter(reach).select("a.num", F.col("b.num").alias("b"))
    return pairs.unionByName(dense).distinct().withColumnRenamed("num", "a")


def few(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows


def with_hit(rows: DataFrame, keys: list[str], ids: DataFrame) -> DataFrame:
    """``rows`` with ``_hit``: false where their ``keys`` are surely no row of ``ids`` (a written
    table of as many columns), by 32-bit hashes that are sent out."""
    n = ids.count()
    if n > HASHED_ROWS:
        return rows.withColumn("_hit", F.lit(True))
    groups = F.lit(max(1, n // HASHES))

    def hashed(cols: list[str]) -> list:
        return [F.pmod(F.xxhash64(*cols), groups).alias("_g"), F.shiftright(F.xxhash64(*cols), 32).cast("int").alias("_h")]

    sent = ids.select(*hashed(ids.columns)).groupBy("_g").agg(F.collect_set("_h").alias("_hs"))
    met = rows.select("*", *hashed(keys)).join(F.broadcast(sent), "_g", "left")
    return met.select(*rows.columns, F.coalesce(F.array_contains("_hs", F.col("_h")), F.lit(False)).alias("_hit"))


def verify(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose texts (num, text) align at ``least`` or more."""

    def run(batches):
        for b in batches:
            for first, end in slices(b.column(2), 4 << 20):
                own = b.slice(first, end - first)
                x, y = labelled(own.column(2)), labelled(own.column(3))
                keep = [similarity(u, v, least) >= least for u, v in zip(x, y, strict=True)]
                yield own.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(texts.select(F.col("num").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("num").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(num, root) for every node of the edges (a < b): root is the least node connected
    to it. Alternates large and small stars until a round changes nothing."""
    edges = written(edges, "edges")
    state = None
    while True:
        # large star: every neighbour above a node hangs on the least node around it
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("m").alias("a"), "b").distinct()
        # small star: a node and its lower neighbours hang on the least of these
        large = written(large, "large-star")
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        hung = large.join(least, "b")
        small = hung.filter(F.col("a") != F.col("m")).select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(
            least.select(F.col("m").alias("a"), "b"))
        edges = written(small.distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("b").alias("num"), F.col("a").alias("root")).unionByName(
                edges.select(F.col("a").alias("num"), F.col("a").alias("root")).distinct())
        state = now


def classes(docs: DataFrame, id_col: str, text_col: str, least: float = SIMILARITY) -> DataFrame:
    """Per row: id, node (of its text), class_id, keeper (the text of the class's least id)."""
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(F.col(text_col).cast("binary"))).alias("node"), F.col(text_col).cast("string").alias("text"))
    seen = written(sketches(rows), "sketches")
    nodes = seen.filter("n > 0").groupBy("node").agg(F.min("id").alias("rep"), F.max("n").alias("n"), F.max("keys").alias("keys"))
    nodes = written(nodes.withColumn("num", F.monotonically_increasing_id()), "nodes")
    shared = buckets(nodes)
    pairs = written(candidates(shared, least), "pairs")

    def texts_of(nums: DataFrame) -> DataFrame:
        met = written(nums.join(nodes.select("num", "node", "rep"), "num"), "met")
        if few(met, BROADCAST_ROWS) or not few(met, HASHED_ROWS):
            sent = F.broadcast(met) if few(met, BROADCAST_ROWS) else met.hint("merge")
            texts = rows.join(sent, (rows["node"] == met["node"]) & rows["id"].eqNullSafe(met["rep"]))
            return written(texts.select(*nums.columns, "text").dropDuplicates(["num"]), "texts")
        # rows of one node have one text; a number and its node are in one task
        own = with_hit(rows, ["node", "id"], met.select("node", "rep")).filter("_hit").select("node", "text")
        texts = own.join(met.hint("merge"), "node").dropDuplicates(["node"])
        return written(texts.select(*nums.columns, "text"), "texts")

    edges = written(verify(pairs, texts_of(pairs.select(F.explode(F.array("a", "b")).alias("num")).distinct()), least), "verified")
    roots = components(edges)
    left = written(unsettled(shared, roots), "unsettled")
    if not left.isEmpty():
        texts = texts_of(left)
        more = written(verify(written(rare_pairs(texts, least), "rare-pairs"), texts, least), "verified")
        if not more.isEmpty():
            roots = components(edges.unionByName(more))
    of = nodes.select("num", "node", "rep").join(roots, "num", "left").withColumn("root", F.coalesce("root", "num"))
    best = of.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull(), F.col("rep"), F.col("node"))).alias("best"))
    of = of.join(best, "root").select(F.col("node").alias("_node"), F.col("best.rep").alias("class_id"), (F.col("best.node") == F.col("node")).alias("keeper"))
    out = seen.select("id", "node", "n").join(of, (F.col("node") == F.col("_node")) & (F.col("n") > 0), "left")
    return out.select("id", "node", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
                      F.coalesce("keeper", F.lit(True)).alias("keeper"), (F.col("n") > 0).alias("has_words"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, class_id, kept (it is the one of its class that stays;
    rows that repeat it say so too)."""
    out = classes(docs, id_col, text_col)
    kept = F.col("keeper") & F.col("id").eqNullSafe(F.col("class_id"))
    return out.select(F.col("id").alias(id_col), "class_id", kept.alias("kept"))


def dedupe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every class; rows without words all stay."""
    found = written(classes(docs, id_col, text_col), "classes")
    kept = F.col("keeper") & F.col("id").eqNullSafe(F.col("class_id"))
    gone = found.filter(F.col("has_words") & ~kept).select(F.col("id").alias("_id"), F.col("node").alias("_node")).distinct()
    again = (found.filter(F.col("has_words") & kept).groupBy("id", "node").count().filter("count > 1")
             .select(F.col("id").alias("_id"), F.col("node").alias("_node")))
    gone, again = written(gone, "gone"), written(again, "again")
    plain = positional(docs)
    own, text = F.col(place(docs, id_col)), F.unhex(F.md5(F.col(place(docs, text_col)).cast("binary")))
    rows, sure = plain.withColumn("_text", text), None
    if few(gone, BROADCAST_ROWS) and few(again, BROADCAST_ROWS):
        gone, again = F.broadcast(gone), F.broadcast(again)
    else:  # rows that are in neither table go as they are, the others meet them by a shuffle
        marked = with_hit(rows, ["_text", place(docs, id_col)], gone.unionByName(again).select("_node", "_id"))
        sure, rows = marked.filter("NOT _hit").select(*plain.columns), marked.filter("_hit").drop("_hit")
        gone, again = gone.hint("merge"), again.hint("merge")
    same = (F.col("_text") == F.col("_node")) & own.eqNullSafe(F.col("_id"))
    left = rows.join(gone, same, "left_anti")
    once = left.join(again, same, "left_anti")
    repeated = left.join(again, same, "left_semi").dropDuplicates([place(docs, id_col), place(docs, text_col)])
    out = once.unionByName(repeated).select(*plain.columns)
    return (sure.unionByName(out) if sure is not None else out).toDF(*docs.columns)

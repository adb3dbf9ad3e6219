"""Sampling, splits, naming and batching.

Two ranking strategies, chosen by what the order is:

* **first-k in key order** (K1, K2, P2): ``row_number() <= k`` over a
  window. Catalyst plans this as a *partial* ``WindowGroupLimit`` before
  the shuffle and a final one after, so a class holding a third of all rows
  still ships at most k rows per map task.
* **full rank in a pseudo-random order** (K3 shuffle + split, K4 naming,
  K6 batching): a plain window would pull a whole class into one task.
  ``hash_rank`` instead splits each group into 16^5 buckets by the prefix
  of an md5 order key, takes running counts over the (small) bucket
  table, and ranks only inside each bucket, so no task holds more than
  ~n/10^6 rows of a group. The rank is exact and equals
  ``row_number() over (partition by g order by md5(key:seed), key) - 1``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_HEX = 5  # 16^5 ~ 1M buckets per group


def order_hash(key: str, seed: str) -> Column:
    """Deterministic shuffle key: md5 of '<key>:<seed>' (hex, lower case)."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def bucketed_rank(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], bucket: Column,
                  out: str = "rank0", with_total: str | None = None) -> DataFrame:
    """0-based rank of each row inside its group by ``order``, without one big window.

    ``bucket`` must be monotone in ``order`` (rows of a lower bucket sort
    before rows of a higher one). Counts per (group, bucket) are a partial
    aggregate; a window over that small table gives each bucket's offset;
    the final ``row_number`` runs per (group, bucket), so a hot group is
    ranked by many tasks. Equal to ``row_number() over (partition by group
    order by order) - 1`` when ``order`` is a total order.
    """
    g = list(group_cols)
    d = df.withColumn("_b", bucket)
    bc = d.groupBy(*g, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    wg = Window.partitionBy(*g).orderBy("_b")
    bc = bc.withColumn("_before", F.coalesce(
        F.sum("_cnt").over(wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if with_total:
        bc = bc.withColumn(with_total, F.sum("_cnt").over(Window.partitionBy(*g)))
    bc = bc.drop("_cnt")
    inb = F.row_number().over(Window.partitionBy(*g, "_b").orderBy(*order))
    return (d.join(bc, g + ["_b"])
            .withColumn(out, F.col("_before") + inb - 1)
            .drop("_b", "_before"))


def hash_rank(df: DataFrame, group_cols: Sequence[str], key: str, seed: str,
              out: str = "rank0", with_total: str | None = None) -> DataFrame:
    """0-based rank of each row inside its group in md5(key:seed) order (ties by key);
    buckets are the first hex digits of the md5, so they are uniform."""
    d = df.withColumn("_h", order_hash(key, seed))
    r = bucketed_rank(d, group_cols, [F.col("_h"), F.col(key)], F.substring("_h", 1, BUCKET_HEX),
                      out=out, with_total=with_total)
    return r.drop("_h")


def first_k_per_group(df: DataFrame, group_col: str, order_cols: Sequence[str], k: int,
                      rn: str = "rn") -> DataFrame:
    """K1/K2: first k rows of each group in ``order_cols`` order (ties: full order)."""
    w = Window.partitionBy(group_col).orderBy(*order_cols)
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= k)


def nth_in_group(df: DataFrame, group_col: str, order_cols: Sequence[str], n: int) -> DataFrame:
    """The row at 0-based offset n of each group."""
    return first_k_per_group(df, group_col, order_cols, n + 1).filter(F.col("rn") == n + 1).drop("rn")


def train_test_split(df: DataFrame, label: str, key: str, seed: str = "42",
                     train_frac: float = 0.7) -> DataFrame:
    """K3: per class, shuffle (md5 order) and put the first floor(frac * n) rows in train.

    Adds ``set`` ('train'/'test') and ``idx`` (K4: 0-based index inside
    (label, set), restarting at 0 in each split).
    """
    r = hash_rank(df, [label], key, seed, out="_r", with_total="_n")
    cut = F.floor(F.col("_n") * F.lit(train_frac))
    is_train = F.col("_r") < cut
    return (r.withColumn("set", F.when(is_train, F.lit("train")).otherwise(F.lit("test")))
            .withColumn("idx", F.when(is_train, F.col("_r")).otherwise(F.col("_r") - cut).cast("long"))
            .drop("_r", "_n"))


def split_names(split: DataFrame, label: str, ext: str = ".png") -> DataFrame:
    """K4: ``<label>_<i>.png`` per row of a split, and its location ``<set>/<label>/<name>``."""
    name = F.concat(F.col(label), F.lit("_"), F.col("idx").cast("string"), F.lit(ext))
    return (split.withColumn("name", name)
            .withColumn("location", F.concat_ws("/", F.col("set"), F.col(label), F.col("name"))))


def label_set_counts(split: DataFrame, label: str, sets: Sequence[str] = ("test", "train")) -> DataFrame:
    """A1: class x split counts, zeros filled (pivot with explicit values: one pass)."""
    return split.groupBy(label).pivot("set", list(sets)).count().na.fill(0)


def add_batches(df: DataFrame, key: str, batch_size: int = 100, n_buckets_hex: int = 1,
                seed: str = "batch") -> DataFrame:
    """K6: ``bucket`` = md5 prefix of the key, ``batch_id`` = floor(rank / batch_size) in it.

    Batches are formed inside hash buckets, so numbering needs no global order.
    """
    b = F.substring(order_hash(key, seed), 1, n_buckets_hex)
    r = hash_rank(df.withColumn("bucket", b), ["bucket"], key, seed, out="_r")
    return r.withColumn("batch_id", F.floor(F.col("_r") / batch_size).cast("long")).drop("_r")


def upload_batches(df: DataFrame, key: str, path: str, required: Sequence[str], max_bytes: int | None = None,
                   batch_size: int = 100) -> DataFrame:
    """Upload records in batches (K6) to the collection at ``path``, with a status per
    record: (key, bucket, batch_id, status, reason).

    A record without its key or a required field, or with one of them above
    ``max_bytes``, is rejected with its reason; the rest is written, batch
    numbers included, and ``succeeded`` is what reading the collection back
    confirms.
    """
    tests = [(f"missing:{c}", F.col(c).isNull()) for c in [key, *required]]
    if max_bytes is not None:
        tests += [(f"too long:{c}", F.octet_length(F.col(c).cast("string")) > max_bytes) for c in required]
    reason = F.array_join(F.array_compact(F.array(*[F.when(bad, F.lit(code)) for code, bad in tests])), ";")
    marked = df.withColumn("_reason", reason)
    rejected = marked.filter(F.col("_reason") != "").select(
        key, F.lit(None).cast("string").alias("bucket"), F.lit(None).cast("long").alias("batch_id"), F.lit("rejected").alias("status"), F.col("_reason").alias("reason"))
    ready = add_batches(marked.filter(F.col("_reason") == "").drop("_reason"), key, batch_size)
    ready.write.partitionBy("bucket").parquet(path)
    there = df.sparkSession.read.schema(ready.schema).parquet(path)
    return rejected.unionByName(there.select(key, F.col("bucket").cast("string"), "batch_id", F.lit("succeeded").alias("status"), F.lit(None).cast("string").alias("reason")))

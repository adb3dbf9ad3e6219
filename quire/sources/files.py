"""File sources and sinks.

All readers take explicit schemas (no inference pass over a 100 TB
folder) and expose the file path through the ``_metadata`` column, so
"which file did this row come from" needs no Python.
"""

from __future__ import annotations

import json
import os
import re
import string
import uuid
from collections.abc import Iterator, Sequence
from fnmatch import fnmatchcase
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import urls as U
from quire.session import cut_lineage

MANIFEST_SCHEMA = T.StructType([
    T.StructField("location", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("set", T.StringType()),
])
FILE_LIST_SCHEMA = T.StructType([T.StructField("file", T.StringType())])


def located(uri: str):
    """(file system, path) of a folder or file, by ``pyarrow.fs``. Names are taken as they are, as
    Spark writes its paths: nothing in a local one is an escape."""
    from pyarrow import fs

    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(quote(uri, safe=string.printable.strip()) if "://" in uri else uri)


def as_uri(name: str) -> str:
    """A path as the URI that ``_metadata.file_path`` has: only what may not stand in one is escaped."""
    return re.sub(r"[^\w!.~'()*:@&=+$,;/-]", lambda m: m[0] if ord(m[0]) > 127 and m[0].isprintable() else quote(m[0]), name)


def put(uri: str, data: bytes) -> None:
    """Write a file under a temporary name and move it to its place."""
    files, path = located(uri)
    folder, _, name = path.rpartition("/")
    files.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(part) as f:
        f.write(data)
    files.move(part, path)


def get(uri: str) -> bytes | None:
    """The bytes of a small file; None if it is not there."""
    files, path = located(uri)
    try:
        with files.open_input_file(path) as f:
            return f.read()
    except FileNotFoundError:
        return None


# ---- listing and reading many files in tasks -----------------------------------

LISTED = "file string, bytes long, modified long, folder boolean"
#: Files of an Arrow batch of a listing.
LISTED_ROWS = 4096
#: Bytes of the bodies that a task holds at once, about.
BODY_BYTES = 4 << 20
#: Bytes of the files that a task reads, about, and those that opening one counts as.
TASK_BYTES, OPEN_BYTES = 128 << 20, 64 << 10


def full_name(uri: str, path: str) -> str:
    """A path of the file system of ``uri`` with its scheme, as Spark writes it."""
    scheme, found, rest = uri.partition("://")
    if not found or scheme == "file":
        return f"file:{path}"
    return f"{scheme}://{rest.partition('/')[0]}{path}" if path.startswith("/") else f"{scheme}://{path}"


def entries(uri: str) -> Iterator[tuple[str, int, int, bool]]:
    """(file, bytes, time of change in nanoseconds, is a folder) of what lies in a folder. A local one is read bit by bit."""
    from pyarrow import fs

    files, path = located(uri)
    if isinstance(files, fs.LocalFileSystem):
        with os.scandir(path) as found:
            for e in found:
                s = e.stat()
                yield full_name(uri, e.path), s.st_size, s.st_mtime_ns, e.is_dir()
    else:
        for i in files.get_file_info(fs.FileSelector(path)):
            yield full_name(uri, i.path), i.size or 0, i.mtime_ns or 0, i.type == fs.FileType.Directory


def make_folder(uri: str) -> None:
    files, path = located(uri)
    files.create_dir(path, recursive=True)


def is_there(uri: str) -> bool:
    from pyarrow import fs

    files, path = located(uri)
    return files.get_file_info(path).type != fs.FileType.NotFound


def hidden(name: str) -> bool:
    """Names that Spark's file sources pass over."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def listed(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(file, bytes, modified) of the files below ``root`` that are not empty and whose names
    match ``pattern``; none if it is not there. Tasks list the folders, level by level: the
    driver holds no file's name."""
    def run(batches):
        for b in batches:
            for uri in b.column(0).to_pylist():
                rows = []
                for e in entries(uri):
                    name = e[0].rpartition("/")[2]
                    if not hidden(name) and (e[3] or (e[1] > 0 and fnmatchcase(name, pattern))):
                        rows.append(e)
                    if len(rows) == LISTED_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["file", "bytes", "modified", "folder"])
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["file", "bytes", "modified", "folder"])

    if not is_there(root):
        return spark.createDataFrame([], LISTED).drop("folder")
    folders, n, levels = spark.createDataFrame([(root,)], "file string"), 1, []
    while n:
        levels.append(cut_lineage(folders.repartition(min(n, 4 * spark.sparkContext.defaultParallelism)).mapInArrow(run, LISTED), "listed"))
        folders = levels[-1].filter("folder").select("file")
        n = folders.count()
    return reduce(DataFrame.unionByName, levels).filter("NOT folder").drop("folder")


def decoded(data: bytes) -> str | None:
    """The text of a JSON file, by the encoding that it is in; None if it is in none."""
    try:
        return data.decode(json.detect_encoding(data))
    except UnicodeDecodeError:
        return None


def bodies(found: DataFrame) -> DataFrame:
    """(file as URI, raw, text) of rows (file, bytes): the files' bytes, and the text where it is other
    than these as UTF-8; null there if they are no text, with ``is_text`` false."""
    size = found.agg(F.sum(F.col("bytes") + OPEN_BYTES)).first()[0] or 0

    def run(batches):
        def out(rows):
            kinds = pa.string(), pa.binary(), pa.string(), pa.bool_()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["file", "raw", "text", "is_text"])

        rows, held = [], 0
        for b in batches:
            for uri in b.column(0).to_pylist():
                files, path = located(uri)
                with files.open_input_file(path) as f:
                    data = f.read()
                text = decoded(data)
                plain = text is not None and json.detect_encoding(data) == "utf-8"
                rows.append((as_uri(uri), data, None if plain else text, text is not None))
                held += len(data)
                if held >= BODY_BYTES:
                    yield out(rows)
                    rows, held = [], 0
        if rows:
            yield out(rows)

    tasks = max(found.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    return found.select("file").repartition(tasks).mapInArrow(run, "file string, raw binary, text string, is_text boolean")


# ---- S1 / S2: manifest CSV ---------------------------------------------------

def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=MANIFEST_SCHEMA)


def write_manifest(df: DataFrame, path: str, partition_by_set: bool = False) -> None:
    w = df.select("location", "label", "set").write.mode("overwrite").option("header", True)
    if partition_by_set:
        w = w.partitionBy("set")
    w.csv(path)


# ---- S3: layout JSON ---------------------------------------------------------

def read_layout(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Every ``*.ocr.json`` below ``root`` as one row + its ``file`` path."""
    df = (spark.read.schema(schema).option("multiLine", True)
          .option("recursiveFileLookup", True).option("pathGlobFilter", "*.ocr.json")
          .json(root))
    return df.withColumn("file", F.col("_metadata.file_path"))


# ---- S4 / S5: class file lists (JSON lines) -----------------------------------

def read_file_lists(spark: SparkSession, root: str) -> DataFrame:
    """(class, file, list_file, list_path): the class is the ``.jsonl`` file stem (may contain spaces)."""
    df = (spark.read.schema(FILE_LIST_SCHEMA).option("recursiveFileLookup", True)
          .option("pathGlobFilter", "*.jsonl").json(root))
    # file names come percent-encoded; a plus sign is itself, not a space
    name = F.col("_metadata.file_name")
    return df.select(F.regexp_extract(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), r"^(.*)\.jsonl$", 1).alias("class"),
                     "file", name.alias("list_file"), F.col("_metadata.file_path").alias("list_path"))


def read_written_file_lists(spark: SparkSession, path: str, class_col: str = "class") -> DataFrame:
    """(class, file) back from ``write_file_lists`` output (class-partitioned JSON);
    the class comes from partition discovery, so a filter on it prunes folders."""
    return (spark.read.schema(T.StructType([T.StructField("file", T.StringType()),
                                            T.StructField(class_col, T.StringType())])).json(path)
            .select(class_col, "file"))


def qualifying_classes(pairs: DataFrame, class_col: str, min_docs: int = 5) -> DataFrame:
    """Classes with at least ``min_docs`` paired documents (partial aggregation)."""
    return (pairs.groupBy(class_col).agg(F.count(F.lit(1)).alias("n_files"))
            .filter(F.col("n_files") >= min_docs))


def of_qualifying_classes(pairs: DataFrame, class_col: str, min_docs: int = 5) -> DataFrame:
    """The rows of the classes of S5. The classes, a row each, are sent to the rows: dealt out
    by class, all rows of one would meet in one task."""
    return pairs.join(F.broadcast(qualifying_classes(pairs, class_col, min_docs).select(class_col)), class_col, "left_semi")


def write_file_lists(pairs: DataFrame, class_col: str, file_col: str, path: str,
                     min_docs: int = 5) -> None:
    """One JSON-lines list per qualifying class: ``<path>/<class_col>=<class>/part-*.json``."""
    (of_qualifying_classes(pairs, class_col, min_docs).select(class_col, F.col(file_col).alias("file"))
     .write.mode("overwrite").partitionBy(class_col).json(path))


def write_class_lists(pairs: DataFrame, class_col: str, file_col: str, path: str, min_docs: int = 5) -> None:
    """S5 by name: ``<class>.jsonl`` lists of the qualifying classes. Every task writes its own,
    in a folder of its own, so a class of any size is written by many tasks; the class is
    the stem of each file. Rows go straight to the open file, one class after the other."""
    def run(batches):
        files, root = located(path)
        folder, current, stream = f"{root}/{uuid.uuid4().hex}", None, None
        for b in batches:
            for name, file in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if name != current:
                    if stream:
                        stream.close()
                    files.create_dir(folder, recursive=True)
                    current, stream = name, files.open_output_stream(f"{folder}/{name}.jsonl")
                stream.write((json.dumps({"file": file}, ensure_ascii=False) + "\n").encode())
        if stream:
            stream.close()
            yield pa.RecordBatch.from_pydict({"folder": [folder]})

    rows = of_qualifying_classes(pairs, class_col, min_docs).select(F.col(class_col).alias("class"), F.col(file_col).alias("file"))
    if not rows.filter(F.col("class").contains("/")).isEmpty():
        raise ValueError("a class name with a slash cannot be the name of a list")
    done = cut_lineage(rows.sortWithinPartitions("class").mapInArrow(run, "folder string"), "list-folders")
    # folders of attempts that did not end are not part of the result
    done.coalesce(1).write.mode("append").text(f"{path}/_lists")


def read_class_lists(spark: SparkSession, path: str) -> DataFrame:
    """(class, file, list_file) of the lists that ``write_class_lists`` finished at ``path``."""
    lists = spark.read.text(f"{path}/_lists").select(F.substring_index("value", "/", -1).alias("folder"))
    df = read_file_lists(spark, path).withColumn("folder", F.element_at(F.split("list_path", "/"), -2))
    return df.join(lists, "folder", "left_semi").drop("folder", "list_path")


# ---- S6 / S7 / S8: binary documents and their metadata ------------------------

def read_documents(spark: SparkSession, root: str,
                   allowed: Sequence[str] = U.IMAGE_EXTENSIONS) -> DataFrame:
    """Recursive binary scan; suffix check is case-insensitive. Paths are plain paths:
    ``#`` and ``?`` are characters of a name like any other."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return df.filter(U.path_extension(F.col("path")).isin([a.lower() for a in allowed]))


def file_metadata(spark: SparkSession, root: str) -> DataFrame:
    """Url, name, size, content type, last_modified — ``content`` is never selected,
    so column pruning keeps the file bodies unread."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    ext = U.path_extension(F.col("path"))
    return df.select(F.col("path").alias("url"), F.substring_index("path", "/", -1).alias("name"),
                     F.col("length").alias("size"), U.mime_type(ext).alias("content_type"),
                     F.col("modificationTime").alias("last_modified"))


def iso_timestamp(ts, ntz: bool = False) -> F.Column:
    """ISO-8601 with offset; microseconds only when non-zero (like Python's isoformat).

    A zoned timestamp prints in the session zone with that zone's offset; a
    zone-less (NTZ) timestamp is taken as UTC, so its text never depends on
    the session's time zone."""
    c = F.col(ts) if isinstance(ts, str) else ts
    us = F.date_format(c, "SSSSSS")
    offset = F.lit("+00:00") if ntz else F.date_format(c, "xxx")
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.concat(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(us == "000000", F.lit("")).otherwise(F.concat(F.lit("."), us)),
        offset))


def format_metadata(meta: DataFrame) -> DataFrame:
    """Rename to (source, name, size, content_type, last_modified ISO string)."""
    ntz = isinstance(meta.schema["last_modified"].dataType, T.TimestampNTZType)
    return meta.select(F.col("url").alias("source"), F.col("name"), F.col("size"),
                       F.col("content_type"), iso_timestamp("last_modified", ntz).alias("last_modified"))


# ---- S9 / S10: multi-format save / load ---------------------------------------

FORMATS = ("csv", "parquet", "json", "orc")
SUFFIX_FORMAT = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".jsonl": "json", ".orc": "orc"}


def save_table(df: DataFrame, path: str, file_format: str = "csv", mode: str = "overwrite") -> None:
    if file_format not in FORMATS:
        raise ValueError(f"cannot save as {file_format!r}; choose one of {', '.join(FORMATS)}")
    w = df.write.mode(mode).format(file_format)
    if file_format == "csv":
        w = w.option("header", True)
    w.save(path)


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Dispatch on the path suffix."""
    low = path.rstrip("/").lower()
    for suf, fmt in SUFFIX_FORMAT.items():
        if low.endswith(suf):
            r = spark.read.format(fmt)
            if schema is not None:
                r = r.schema(schema)
            if fmt == "csv":
                r = r.option("header", True)
                if schema is None:
                    r = r.option("inferSchema", True)
            return r.load(path)
    raise ValueError(f"cannot tell the format of {path!r}; known endings are {', '.join(SUFFIX_FORMAT)}")


# ---- S14: download plan --------------------------------------------------------

def download_plan(listing: DataFrame, path_col: str, prefix: str, dest: str) -> DataFrame:
    """(path, destination, collisions): basename destinations under ``dest`` for
    objects below ``prefix``; ``collisions`` > 1 flags names that would overwrite."""
    sel = listing.filter(U.url_path(F.col(path_col)).startswith(prefix))
    name = U.basename(F.col(path_col))
    out = sel.select(F.col(path_col).alias("path"), name.alias("name"),
                     F.concat(F.lit(dest.rstrip("/") + "/"), name).alias("destination"))
    counts = out.groupBy("name").agg(F.count(F.lit(1)).alias("collisions"))
    return out.join(counts, "name")

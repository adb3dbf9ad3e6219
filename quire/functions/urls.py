"""URL and object-path expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import col_

# Accepted document suffixes (case-insensitive).
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".bmp", ".tiff", ".heif")
TRAIN_EXTENSIONS = IMAGE_EXTENSIONS + (".pdf", ".docx", ".xlsx", ".pptx")
# Suffixes the training upload accepts besides documents.
SIDE_FILE_SUFFIXES = (".ocr.json", ".jsonl")

# Suffix -> MIME type for the metadata table.
MIME_TYPES = {
    ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".bmp": "image/bmp",
    ".tiff": "image/tiff", ".heif": "image/heif", ".pdf": "application/pdf",
    ".html": "text/html", ".json": "application/json",
}

_SCHEME_AUTH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"


def url_path(url) -> Column:
    """Path part of a URL (lenient like a generic URL splitter: no exception on odd input).

    Scheme and authority are removed, then query and fragment; a plain
    local path stays as it is.
    """
    return F.regexp_replace(F.regexp_replace(col_(url), _SCHEME_AUTH, ""), r"[?#].*$", "")


def container_and_blob(url) -> tuple[Column, Column]:
    """container = first path segment, blob = the rest joined by '/'."""
    segs = F.split(F.regexp_replace(url_path(url), r"^/+", ""), "/")
    container = F.element_at(segs, 1)
    blob = F.array_join(F.slice(segs, 2, F.greatest(F.size(segs) - 1, F.lit(0))), "/")
    return container, blob


def route(url, object_host_suffix: str) -> Column:
    """P4: 'error' for http://, 'object' for https on the object store, 'url' for
    other https, 'local' otherwise."""
    u = col_(url)
    host = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return (F.when(u.startswith("http://"), F.lit("error"))
            .when(u.startswith("https://") & host.endswith(object_host_suffix), F.lit("object"))
            .when(u.startswith("https://"), F.lit("url"))
            .otherwise(F.lit("local")))


def extension(path) -> Column:
    """Lower-case suffix including the dot of the last path segment ('' if none)."""
    return F.lower(F.regexp_extract(url_path(path), r"(\.[A-Za-z0-9]+)$", 1))


def path_extension(path) -> Column:
    """Lower-case suffix of a plain path (no URL: ``#`` and ``?`` may be part of a name)."""
    return F.lower(F.regexp_extract(F.substring_index(col_(path), "/", -1), r"(\.[A-Za-z0-9]+)$", 1))


def has_extension(path, allowed: Sequence[str]) -> Column:
    return extension(path).isin([a.lower() for a in allowed])


def basename(path) -> Column:
    return F.regexp_extract(url_path(path), r"([^/]*)$", 1)


def mime_type(ext_col) -> Column:
    m = F.create_map(*[x for k, v in MIME_TYPES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, col_(ext_col)), F.lit("application/octet-stream"))


def object_name(path, root: str) -> Column:
    """Path relative to ``root`` with '/' separators."""
    p = F.translate(col_(path), "\\", "/")
    r = root.replace("\\", "/").rstrip("/") + "/"
    return F.when(p.startswith(r), F.substring(p, len(r) + 1, 1 << 30)).otherwise(p)

import base64
import hashlib
import io
import random
import zipfile
import zlib

import pytest

from quire.llm import zip_warc as ZW
from tests.llm.fixtures import clashing

SCHEMA = "page_id long, url string, html string"


def pages(seed=0, n=120):
    rng = random.Random(seed)
    rows = [(i * 3, f"http://h{i % 5}.example/p?q={i}", rng.choice(["<p>same</p>", "", f"<p>{i}</p>" * rng.randint(1, 400), "ä\r\n\r\nö 日本"])) for i in range(n)]
    rows += [(7, None, None), (8, "http://x/\r\nWARC-Type: evil", "WARC/1.1\r\n\r\nPK\x05\x06"), (None, "u", "<p>orphan</p>"), (None, "v", "<p>same</p>"),
             (-4, "http://x/é ü", "<p>same</p>"), (-4, "http://x/é ü", "<p>same</p>"), (1000, "long", "x\n" * 700_000), (1001, "long", "x\n" * 700_000)]
    rng.shuffle(rows)
    return rows


def brute(rows, min_bytes=0):
    """One row a page; of repeated rows one is the response."""
    out, seen = [], {}
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        if len(data) >= min_bytes and data in seen:
            out.append((i, len(data), digest, "revisit", seen[data]))
        else:
            seen.setdefault(data, i)
            out.append((i, len(data), digest, "response", None))
    return sorted(out, key=repr)


def read(path):
    data = open(path.replace("file:", "", 1) if path.startswith("file:") else path, "rb").read()
    return data, lambda at, n: data[at:at + n]


@pytest.mark.parametrize("min_bytes", [0, 11, 12, 10 ** 9])
def test_round_trip_equals_brute_force(spark, min_bytes):
    rows = pages(1)
    got = [tuple(r) for r in ZW.archive_round_trip(spark.createDataFrame(rows, SCHEMA), min_bytes=min_bytes).collect()]
    assert sorted(got, key=repr) == brute(rows, min_bytes)


def test_payloads_urls_and_many_small_archives(spark):
    rows = pages(2)
    df = clashing(spark.createDataFrame(rows, SCHEMA)).toDF("page_id", "url", "html", "payload", "bytes", "a.b", "num", "n", "digest")
    archives = ZW.write_archives(df, archive_bytes=40_000, member_bytes=5_000)
    assert archives.count() > 5 and archives.agg({"records": "sum"}).first()[0] == len(rows)
    got = ZW.read_archives(archives, "long", range_bytes=3_000).collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=repr) == brute(rows)
    text = {}
    for i, u, h in rows:
        text.setdefault(i, []).append(h or "")
    for r in got:
        if r["record_type"] == "response":
            assert bytes(r["payload"]).decode() in text[r["page_id"]]
        else:
            assert r["payload"] is None
    url = {r["page_id"]: r["url"] for r in got}
    assert url[7] is None and url[8] == "http://x/%0D%0AWARC-Type:%20evil" and url[0] == "http://h0.example/p?q=0"


def test_other_zip_readers_agree(spark):
    for r in ZW.write_archives(spark.createDataFrame(pages(3), SCHEMA), member_bytes=20_000).collect():
        data, read_at = read(r["path"])
        assert len(data) == r["bytes"]
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            assert z.testzip() is None
            found = ZW.members(read_at, len(data))
            assert [(m.name, m.method, m.size) for m in found] == [(i.filename, i.compress_type, i.file_size) for i in z.infolist()]
            for m in found:
                assert read_at(m.start(read_at), m.size) == z.read(m.name)
            assert sum(len(z.read(m.name).splitlines()) for m in found if m.name == ZW.INDEX) == r["records"]


@pytest.mark.parametrize("comment,limit", [(b"", None), (b"a comment with PK\x05\x06 in it", None), (b"", 10), (b"c" * 300, 10)])
def test_archives_of_another_writer(spark, tmp_dir, monkeypatch, comment, limit):
    """No index, members stored as they are or as gzip records, a deflated member beside
    them; with and without the ZIP64 fields and a comment."""
    if limit:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    rows = [(str(i), "u", f"page {i}\r\n\r\n" * (i * 500)) for i in range(6)]
    packed = [ZW.record_bytes(i, u, h.encode(), len(h), ZW.base32(hashlib.sha1(h.encode()).hexdigest()), None, False) for i, u, h in rows]
    info = zlib.compress(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n", wbits=31)
    path = f"{tmp_dir}/other.wacz"
    with zipfile.ZipFile(path, "w") as z:
        z.comment = comment
        z.writestr("pages/pages.jsonl", "{}" * 1000, zipfile.ZIP_DEFLATED)
        z.writestr("archive/a.warc.gz", info + b"".join(packed[:3]))
        z.writestr("archive/b.warc", b"".join(zlib.decompress(p, 31) for p in packed[3:]))
    data, read_at = read(path)
    assert [m.name for m in ZW.members(read_at, len(data))] == ["pages/pages.jsonl", "archive/a.warc.gz", "archive/b.warc"]
    got = ZW.read_archives(spark.createDataFrame([(path, len(data))], "path string, bytes long"))
    assert sorted((r["page_id"], bytes(r["payload"]).decode()) for r in got.collect()) == [(i, h) for i, _, h in rows]


def test_what_is_no_archive(tmp_dir):
    with pytest.raises(ValueError, match="not a ZIP file"):
        ZW.members(lambda at, n: (b"x" * 500)[at:at + n], 500)
    with pytest.raises(ValueError, match="not a ZIP file"):
        ZW.members(lambda at, n: b"", 0)
    path = f"{tmp_dir}/deflated.wacz"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/a.warc", b"x" * 1000)
    with pytest.raises(ValueError, match="not stored"):
        list(ZW.ranges_of(path, 1000))


def test_a_damaged_payload_is_an_error():
    data = zlib.decompress(ZW.record_bytes("1", "u", b"hello", 5, ZW.base32(hashlib.sha1(b"other").hexdigest()), None, False), 31)
    with pytest.raises(ValueError, match="record <urn:page:1>"):
        ZW.parse(data)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert ZW.write_archives(df).count() == 0
    got = ZW.archive_round_trip(df)
    assert got.count() == 0 and got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]

import base64
import gzip
import hashlib
import io
import os
import sys
import zlib

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from corpus import CLASHES, sentence  # noqa: E402

from alignfold.llm import warc  # noqa: E402
from alignfold.llm.common import scratch_path  # noqa: E402


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def awkward():
    import random
    rng = random.Random(2)
    rows = [(1, "http://a/1", "same"), (7, "http://a/7", "same"), (3, None, "same"), (None, "http://a/none", "same"),
            (4, "http://a/4", None), (5, "http://a/5", ""), (6, "http://a/é\r\nWARC-Type: trap\r\n\r\n", "naïve 😀\r\n\r\nWARC/1.1\r\n"),
            (8, "http://a/8", "x" * 1_500_000), (9, "http://a/9", "x" * 1_500_000), (10, "u", "twice"), (10, "u", "twice"),
            (None, None, "no id"), (None, None, "no id"), (-2, "neg", "only here")]
    return rows + [(100 + i, f"http://b/{i}", sentence(rng, rng.randint(1, 60))) for i in range(50)]


def expected(rows, min_bytes=0):
    """(id, bytes, digest, kind, refers to) of each row."""
    top = {}
    for k, (doc, _, text) in enumerate(rows):
        best = top.get(text or "")
        if best is None or (doc is not None and (rows[best][0] is None or doc >= rows[best][0])):
            top[text or ""] = k
    out = []
    for k, (doc, _, text) in enumerate(rows):
        first = top[text or ""]
        size = len((text or "").encode())
        alone = first == k or size < min_bytes
        out.append((doc, size, digest(text), "response" if alone else "revisit", None if alone else rows[first][0]))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def digested(df):
    return sorted(((None if r.document_id is None else int(r.document_id), r.payload_bytes, r.payload_sha1, r.record_type,
                    None if r.refers_to is None else int(r.refers_to)) for r in df.collect()), key=str)


@pytest.mark.parametrize("min_bytes", [0, 6])
def test_round_trip_of_awkward_rows(spark, min_bytes):
    rows, folder = awkward(), scratch_path(spark, "warc-test")
    df = frame(spark, rows)
    for part in CLASHES.split(", "):
        name, kind = part.split()
        df = df.withColumn(name, F.lit(None).cast(kind))
    warc.write_archive(df.withColumn("row", F.lit("x")).withColumn("payload", F.lit(1)), folder, min_bytes=min_bytes, file_bytes=2_000)
    assert digested(warc.resolved(spark, folder)) == expected(rows, min_bytes)
    assert len(warc.archive_files(folder)) > 3
    full = warc.read_archive(spark, folder)
    texts = sorted(bytes(r.payload).decode() for r in full.filter("record_type = 'response'").collect())
    assert texts == sorted([text or "" for _, _, text in rows if len((text or "").encode()) < min_bytes]
                           + list({text or "" for _, _, text in rows if len((text or "").encode()) >= min_bytes}))
    heads = full.filter("record_type = 'revisit'").select("http_length", "payload_bytes", "payload_digest", "refers_to").collect()
    assert all(r.payload_bytes == 0 and r.payload_digest and r.refers_to for r in heads)


def test_empty_table_and_second_write(spark):
    folder = scratch_path(spark, "warc-test")
    warc.write_archive(frame(spark, []), folder)
    assert digested(warc.resolved(spark, folder)) == []
    warc.write_archive(frame(spark, [(1, "u", "a")]), folder)
    warc.write_archive(frame(spark, [(2, "u", "a")]), folder)  # another write is another archive: no links across
    assert digested(warc.resolved(spark, folder)) == expected([(1, "u", "a")]) + expected([(2, "u", "a")])


def test_files_of_failed_tasks_are_not_read(spark):
    folder = scratch_path(spark, "warc-test")
    warc.write_archive(frame(spark, [(1, "u", "a")]), folder)
    files, base = warc.fs.FileSystem.from_uri(folder)
    with files.open_output_stream(f"{base}/part-left.warc.gz", compression=None) as f:
        f.write(b"half a fi")
    assert warc.read_archive(spark, folder).filter("record_type = 'response'").count() == 1


PAYLOADS = [b"first " * 5000, b"", b"third\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", b"fourth"]


def plain(kinds=("response", "resource", "metadata", "response")):
    out = []
    for i, (kind, body) in enumerate(zip(kinds, PAYLOADS)):
        web = b"HTTP/1.1 404 Not Found\r\nServer: x\r\n\r\n" if kind == "response" else b""
        head = warc.lines([("WARC-Type", kind), ("WARC-Record-ID", f"<urn:{i}>"), ("WARC-Target-URI", f"http://h/{i}"),
                           ("Content-Type", "application/http; msgtype=response" if web else "text/plain"),
                           ("WARC-Payload-Digest", "sha1:" + warc.base32(hashlib.sha1(body).digest())),
                           ("Folded", "one\r\n two"), ("Content-Length", len(web + body))])
        out.append((head.encode() + b"\r\n" + web + body + b"\r\n\r\n"))
    return out


FORMS = {"plain.warc": lambda: b"".join(plain()), "members.warc.gz": lambda: b"".join(gzip.compress(r) for r in plain()),
         "one-member.warc.gz": lambda: gzip.compress(b"".join(plain())),
         "pairs.warc.gz": lambda: b"".join(gzip.compress(b"".join(plain()[i:i + 2])) for i in (0, 2))}


@pytest.mark.parametrize("form", FORMS)
def test_archives_of_others_and_pushed_predicates(spark, tmp_path, form):
    path = tmp_path / form
    path.write_bytes(FORMS[form]())
    df = warc.read_archive(spark, str(path))
    rows = df.collect()
    assert [bytes(r.payload) for r in rows] == PAYLOADS and [r.http_status for r in rows] == [404, None, None, 404]
    assert all(r.payload_sha1 == r.payload_digest for r in rows)
    for test in ("record_type = 'response'", "record_type IN ('resource', 'metadata')", "target_uri LIKE 'http://h/2%'",
                 "content_length > 40", "record_type <> 'response'", "document_id IS NULL AND record_id >= '<urn:2>'",
                 "NOT target_uri LIKE '%3'", "document_id = 'x'", "record_type IN ('resource', NULL)", "http_status = 404",
                 "record_type = 'response' OR content_length < 10"):
        want = [r.record_id for r in spark.createDataFrame(rows, df.schema).filter(test).collect()]
        assert [r.record_id for r in df.filter(test).collect()] == want, test
        for payload in ("none", "digest"):
            got = warc.read_archive(spark, str(path), payload).filter(test).collect()
            assert [r.record_id for r in got] == want and all(r.payload is None for r in got)


def test_predicates_reach_the_reader_and_unwanted_payloads_are_not_inflated(spark):
    df = warc.read_archive(spark, scratch_path(spark, "none"), "none").filter("record_type = 'revisit' AND content_length > 3")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "Filter (" not in plan and "Filter (" in df.filter("payload_bytes > 1") \
        ._jdf.queryExecution().executedPlan().toString()  # Spark has nothing left to test but what is no header
    big = "".join(map(chr, range(40, 120))) * 200_000
    body = warc.member(warc.lines([("WARC-Type", "resource"), ("Content-Length", len(big))]), big.encode())
    last = warc.member(warc.lines([("WARC-Type", "metadata"), ("Content-Length", 2)]), b"ok")

    class Counting(io.BytesIO):
        bytes_read = 0

        def read(self, n=-1):
            got = super().read(n)
            Counting.bytes_read += len(got)
            return got

    inflated = []
    real = zlib.decompressobj

    class Counted:
        def __init__(self, bits):
            self.d = real(bits)

        def decompress(self, data, most):
            got = self.d.decompress(data, most)
            inflated.append(len(got))
            return got

        def __getattr__(self, name):
            return getattr(self.d, name)

    warc.zlib.decompressobj, kept = Counted, warc.zlib.decompressobj
    try:
        got = list(warc.read_records(Counting(body + last), "x", lambda row: row["record_type"] == "metadata", "bytes", True))
    finally:
        warc.zlib.decompressobj = kept
    assert [r["payload"] for r in got] == [b"ok"] and sum(inflated) < 2 * warc.CHUNK < len(big)


@pytest.mark.parametrize("broken", ["cut", "junk", "nolength"])
def test_broken_archives(spark, tmp_path, broken):
    good = plain()
    data = {"cut": good[0] + good[3][:-30], "junk": good[0] + b"this is no record\r\n\r\n", "nolength": good[0] + b"WARC/1.1\r\nWARC-Type: x\r\n\r\n"}
    (tmp_path / "a.warc").write_bytes(data[broken])
    (tmp_path / "b.warc").write_bytes(good[1])
    with pytest.raises(Exception, match="a.warc"):
        warc.read_archive(spark, str(tmp_path)).collect()
    got = warc.read_archive(spark, str(tmp_path), mode="dropmalformed").collect()
    assert sorted(r.record_id for r in got) == ["<urn:0>", "<urn:1>"]


def test_files_are_planned_by_size(tmp_path):
    for i, n in enumerate((10, 50, 10, 30, 200)):
        (tmp_path / f"{i}.warc").write_bytes(b"x" * n)
    (tmp_path / "notes.txt").write_bytes(b"x")
    parts = warc.WarcReader({"path": str(tmp_path), "partbytes": "60"}).partitions()
    assert sorted(sorted(os.path.basename(p) for p in part.paths) for part in parts) == [["0.warc", "2.warc", "3.warc"], ["1.warc"], ["4.warc"]]


def test_members_are_gzip():
    raw = warc.member(warc.lines([("WARC-Type", "resource"), ("Content-Length", 3)]), b"abc")
    assert gzip.decompress(raw + raw) == (b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n") * 2

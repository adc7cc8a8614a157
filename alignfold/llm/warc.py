"""WARC archives as a Spark data source, and a writer that stores equal payloads once.

``spark.read.format("warc")`` plans one task for each run of files of about ``PART_BYTES``. A task reads a
record's header lines first. Predicates on them (record type, ids, URI, date, lengths, digest) are pushed
into the reader, and of a record that fails them no payload is decoded: an uncompressed record is passed
by a seek, a gzip member by the lengths in its 'sl' extra field, and only a member without that field is
inflated to find its end. The option ``payload`` says what is made of wanted records: ``none`` stops after
the HTTP head, ``digest`` streams the payload through SHA-1, ``bytes`` returns it too.

``spark.write.format("warc")`` writes each record as a gzip member of its own. Tasks write files of their
own names, and only files that a committed manifest lists are read, so lost and repeated tasks leave no
record behind.
"""

from __future__ import annotations

import base64
import hashlib
import json
import operator
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from alignfold.functions.rows import join_hot
from alignfold.llm.common import prepared, scratch_path, stage

PART_BYTES = 128 << 20  # bytes of files that one task reads, unless one file is larger
FILE_BYTES = 1 << 30  # bytes after which a task begins a new file
CHUNK = 1 << 18  # bytes read and inflated at a time
BATCH_BYTES, BATCH_ROWS = 8 << 20, 4096
HEAD_LIMIT = 1 << 20  # bytes of header lines beyond which a record is malformed

# fixed values: names of WARC 1.1 header lines, and the column that holds each
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "record_date": "warc-date",
           "target_uri": "warc-target-uri", "refers_to": "warc-refers-to", "content_type": "content-type",
           "content_length": "content-length", "payload_digest": "warc-payload-digest", "document_id": "x-document-id"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INFO = b"software: alignfold\r\nformat: WARC File Format 1.1\r\n"

READ_SCHEMA = ("record_type string, record_id string, record_date string, target_uri string, refers_to string, "
               "content_type string, content_length long, payload_digest string, document_id string, file string, "
               "offset long, http_status int, http_length long, payload_bytes long, payload_sha1 string, payload binary")
ARROW_SCHEMA = pa.schema([(f.split()[0], {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[
    f.split()[1]]) for f in READ_SCHEMA.split(", ")])


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


class Malformed(ValueError):
    """An archive that does not follow the format."""


# ---------- reading ----------
class Window:
    """Buffered reading of a file with seeks past what is not wanted."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.buffer, self.at = file, b"", 0  # ``at``: place in the file of the buffer's first byte

    def peek(self, n: int) -> bytes:
        while len(self.buffer) < n:
            more = self.file.read(max(CHUNK, n - len(self.buffer)))
            if not more:
                break
            self.buffer += more
        return self.buffer[:n]

    def take(self, n: int) -> bytes:
        out = self.peek(n)
        self.buffer, self.at = self.buffer[len(out):], self.at + len(out)
        return out

    def go_to(self, place: int) -> None:
        held = place - self.at
        if 0 <= held <= len(self.buffer):
            self.buffer = self.buffer[held:]
        else:
            self.file.seek(place)
            self.buffer = b""
        self.at = place


class Plain:
    """Records of an uncompressed file."""

    def __init__(self, window: Window):
        self.window = window

    def begin(self) -> int:
        return self.window.at

    def until(self, mark: bytes, limit: int) -> bytes:
        """Bytes up to and with ``mark``; empty at the end of the file."""
        n = 1024
        while True:
            got = self.window.peek(n)
            found = got.find(mark, 0, limit + len(mark))
            if found >= 0:
                return self.window.take(found + len(mark))
            if len(got) < n or n >= limit + len(mark):
                break
            n *= 4
        if not got.strip():
            self.window.take(len(got))
            return b""
        raise Malformed("no end of the header lines")

    def read(self, n: int) -> bytes:
        got = self.window.take(n)
        if len(got) < n:
            raise Malformed("the file ends inside a record")
        return got

    def pass_over(self, n: int) -> None:
        self.window.go_to(self.window.at + n)


class Zipped(Plain):
    """Records of a file of gzip members: any number of records a member, any number of members."""

    def __init__(self, window: Window):
        super().__init__(window)
        self.out, self.inflate, self.start, self.length = b"", None, 0, None

    def open_member(self) -> bool:
        self.start, self.length = self.window.at, None
        head = self.window.peek(12)
        if not head:
            return False
        if head[:3] != b"\x1f\x8b\x08":
            raise Malformed("not a gzip member")
        if len(head) == 12 and head[3] & 4:
            extra = self.window.peek(12 + struct.unpack("<H", head[10:12])[0])[12:]
            while len(extra) >= 4:
                size = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and size == 8:
                    self.length = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + size:]
        self.inflate = zlib.decompressobj(31)
        return True

    def fill(self) -> bool:
        """Some more inflated bytes; false at the end of the file."""
        while True:
            if self.inflate is None and not self.open_member():
                return False
            data = self.inflate.unconsumed_tail or self.window.take(len(self.window.peek(1)) and len(self.window.buffer))
            if not data and not self.inflate.eof:
                raise Malformed("the file ends inside a gzip member")
            try:
                more = self.inflate.decompress(data, CHUNK)
            except zlib.error as e:
                raise Malformed(str(e)) from e
            if self.inflate.eof:  # what follows belongs to the next member
                rest = self.inflate.unused_data
                self.window.buffer, self.window.at = rest + self.window.buffer, self.window.at - len(rest)
                self.inflate = None
            if more:
                self.out += more
                return True

    def begin(self) -> int:
        """Place of the member in which the next record begins."""
        self.alone = not self.out and self.inflate is None
        if not self.out:
            self.fill()
        return self.start

    def until(self, mark: bytes, limit: int) -> bytes:
        while (found := self.out.find(mark)) < 0:
            if len(self.out) > limit or not self.fill():
                if not self.out.strip():
                    self.out = b""
                    return b""
                raise Malformed("no end of the header lines")
        got, self.out = self.out[:found + len(mark)], self.out[found + len(mark):]
        return got

    def read(self, n: int) -> bytes:
        while len(self.out) < n:
            if not self.fill():
                raise Malformed("the file ends inside a record")
        got, self.out = self.out[:n], self.out[n:]
        return got

    def pass_over(self, n: int) -> None:
        if self.alone and self.length:  # the record is the member
            self.window.go_to(self.start + self.length)
            self.out, self.inflate = b"", None
            return
        while n > 0:
            step = min(n, CHUNK)
            self.read(step)
            n -= step


def fields_of(head: bytes) -> dict[str, str]:
    """Header lines by lower-cased name; a line that begins with white space goes on from the one before."""
    out, name = {}, None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def columns_of(fields: dict[str, str]) -> dict:
    """The columns that header lines fill."""
    out = {c: fields.get(h) for c, h in HEADERS.items()}
    out["content_length"] = int(out["content_length"]) if (out["content_length"] or "").isdigit() else None
    digest = out["payload_digest"]
    if digest and digest[:5].lower() == "sha1:":
        out["payload_digest"] = digest[5:]
    return out


COMPARE = {ds.EqualTo: operator.eq, ds.GreaterThan: operator.gt, ds.GreaterThanOrEqual: operator.ge, ds.LessThan: operator.lt,
           ds.LessThanOrEqual: operator.le, ds.StringStartsWith: str.startswith, ds.StringEndsWith: str.endswith,
           ds.StringContains: operator.contains, ds.In: lambda x, many: x in many}


def holds(test: ds.Filter, row: dict) -> bool | None:
    """A pushed predicate on the columns of header lines, by SQL's three values."""
    if isinstance(test, ds.Not):
        got = holds(test.child, row)
        return None if got is None else not got
    x = row[test.attribute[0]]
    if isinstance(test, ds.IsNull):
        return x is None
    if isinstance(test, ds.IsNotNull):
        return x is not None
    if isinstance(test, ds.EqualNullSafe):
        return x == test.value
    return None if x is None or test.value is None else COMPARE[type(test)](x, test.value)


def can_push(test: ds.Filter) -> bool:
    if isinstance(test, ds.Not):
        return can_push(test.child)
    if not isinstance(test, (*COMPARE, ds.IsNull, ds.IsNotNull, ds.EqualNullSafe)):
        return False
    # an IN list with a null is neither true nor false for values it lacks: left to Spark
    return tuple(test.attribute)[:1] == tuple(test.attribute) and test.attribute[0] in HEADERS and not (
        isinstance(test, ds.In) and None in test.value)


def read_records(file: pa.NativeFile, path: str, wanted: Callable[[dict], bool], payload: str,
                 zipped: bool) -> Iterator[dict]:
    """The wanted records of a file, in order."""
    source = (Zipped if zipped else Plain)(Window(file))
    while True:
        offset = source.begin()
        head = source.until(b"\r\n\r\n", HEAD_LIMIT)
        if not head:
            return
        if not head.lstrip(b"\r\n").startswith(b"WARC/"):
            raise Malformed(f"no record at {offset}")
        row = columns_of(fields_of(head.lstrip(b"\r\n")))
        left = row["content_length"]
        if left is None:
            raise Malformed(f"a record without a length at {offset}")
        if not wanted(row):
            source.pass_over(left + 4)
            continue
        row |= {"file": path, "offset": offset}
        if (row["content_type"] or "").startswith("application/http"):
            web = source.until(b"\r\n\r\n", min(left, HEAD_LIMIT)) if left else b""
            left -= len(web)
            status, lengths = web.split(b"\r\n", 1)[0].split(b" "), fields_of(web).get("content-length", "")
            row["http_status"] = int(status[1]) if len(status) > 1 and status[1].isdigit() else None
            row["http_length"] = int(lengths) if lengths.isdigit() else None
        if payload == "none":
            source.pass_over(left + 4)
        else:
            sha, kept = hashlib.sha1(), []
            row["payload_bytes"] = left
            while left:
                step = source.read(min(left, CHUNK))
                sha.update(step)
                left -= len(step)
                if payload == "bytes":
                    kept.append(step)
            row["payload_sha1"] = base32(sha.digest())
            row["payload"] = b"".join(kept) if payload == "bytes" else None
            source.pass_over(4)
        yield row


@dataclass
class Files(ds.InputPartition):
    paths: list[str]


class WarcReader(ds.DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload = options["path"], options.get("payload", "bytes")
        self.mode, self.part_bytes = options.get("mode", "failfast").lower(), int(options.get("partbytes", PART_BYTES))
        if self.payload not in ("none", "digest", "bytes") or self.mode not in ("failfast", "dropmalformed"):
            raise ValueError(f"no such option: payload={self.payload}, mode={self.mode}")
        self.tests: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        for test in filters:
            if can_push(test):
                self.tests.append(test)
            else:
                yield test

    def partitions(self) -> list[Files]:
        """Files, largest first, each to the first task with room for it."""
        bins: list[list] = []
        for size, path in sorted(archive_files(self.path), key=lambda f: (-f[0], f[1])):
            if bins and bins[-1][0] + size <= self.part_bytes:
                bins[-1][0] += size
                bins[-1][1].append(path)
            else:
                bins.append([size, [path]])
        return [Files(paths) for _, paths in bins] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(self.path)
        rows, held = [], 0
        for path in partition.paths:
            with files.open_input_file(path) as f:
                zipped = f.read(2) == b"\x1f\x8b"
                f.seek(0)
                try:
                    for row in read_records(f, path, lambda row: all(holds(t, row) for t in self.tests), self.payload, zipped):
                        rows.append(row)
                        held += len(row.get("payload") or b"") + 400
                        if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                            yield pa.RecordBatch.from_pylist(rows, ARROW_SCHEMA)
                            rows, held = [], 0
                except Malformed as e:
                    if self.mode == "failfast":
                        raise Malformed(f"{path}: {e}") from e
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW_SCHEMA)


def archive_files(folder: str) -> list[tuple[int, str]]:
    """(size, path) of the archives in a folder, those that its manifests list if it has manifests; or of one file."""
    files, base = fs.FileSystem.from_uri(folder)
    info = files.get_file_info(base)
    if info.type == fs.FileType.File:
        return [(info.size, info.path)]
    held = files.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
    lists = [f for f in held if f.base_name.startswith("_manifest-")]
    listed = set()
    for one in lists:
        with files.open_input_file(one.path) as f:
            listed.update(json.loads(f.read()))
    return [(f.size, f.path) for f in held if f.type == fs.FileType.File and f.base_name.endswith((".warc", ".warc.gz"))
            and (not lists or f.base_name in listed)]


# ---------- writing ----------
def member(head: str, block: bytes, level: int = 6) -> bytes:
    """A record as a gzip member whose extra field 'sl' holds its lengths, packed and plain."""
    plain = head.encode() + b"\r\n" + block + b"\r\n\r\n"
    body = zlib.compressobj(level, zlib.DEFLATED, -15)
    data = body.compress(plain) + body.flush()
    whole = 10 + 14 + len(data) + 8
    tail = struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)
    if max(whole, len(plain)) >> 32:  # lengths that do not fit: readers inflate to find the end
        return b"\x1f\x8b\x08\x00" + bytes(4) + b"\x00\xff" + data + tail
    extra = struct.pack("<H2sHII", 12, b"sl", 8, whole, len(plain))
    return b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + extra + data + tail


def lines(pairs: Iterable[tuple[str, object]]) -> str:
    """Header lines; control characters, which would end a line, become percent codes; nulls are left out."""
    out = "WARC/1.1\r\n"
    for name, value in pairs:
        if value is not None:
            text = "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in str(value))
            out += f"{name}: {text}\r\n"
    return out


def record(row: dict) -> bytes:
    """The member of one row of ``write_archive``."""
    web = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    block = web if revisit else web + row["payload"]
    return member(lines([
        ("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["record_date"]),
        ("WARC-Target-URI", row["target_uri"]), ("WARC-Payload-Digest", "sha1:" + base32(bytes.fromhex(row["sha1"]))),
        ("WARC-Profile", PROFILE if revisit else None), ("WARC-Refers-To", row["refers_to"]),
        ("X-Document-Id", row["document_id"]), ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block))]), block)


@dataclass
class Written(ds.WriterCommitMessage):
    names: list[str]


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.file_bytes, self.date = int(options.get("filebytes", FILE_BYTES)), options.get("date", "1970-01-01T00:00:00Z")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, base = fs.FileSystem.from_uri(self.path)
        files.create_dir(base, recursive=True)
        names, out, size = [], None, 0
        try:
            for batch in iterator:
                for i in range(batch.num_rows):
                    if out is None or size >= self.file_bytes:
                        if out is not None:
                            out.close()
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, size = files.open_output_stream(f"{base}/{names[-1]}", compression=None), 0
                        out.write(member(lines([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                                                ("WARC-Date", self.date), ("WARC-Filename", names[-1]),
                                                ("Content-Type", "application/warc-fields"), ("Content-Length", len(INFO))]), INFO))
                    row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                    size += out.write(record(row | {"record_date": self.date}))
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        """The manifest makes the files of all tasks readable at once."""
        files, base = fs.FileSystem.from_uri(self.path)
        files.create_dir(base, recursive=True)
        before = [f.path for f in files.get_file_info(fs.FileSelector(base)) if f.base_name.startswith("_manifest-")]
        with files.open_output_stream(f"{base}/_manifest-{uuid.uuid4().hex}") as f:
            f.write(json.dumps([n for m in messages if m for n in m.names]).encode())
        if self.overwrite:
            for path in before:
                files.delete_file(path)


class WarcSource(ds.DataSource):
    """The data source ``warc``. Options: ``payload``, ``mode`` (``dropmalformed`` leaves out the rest of a broken
    file), ``partbytes``; for writing ``filebytes`` and ``date``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:  # noqa: ANN001
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:  # noqa: ANN001
        return WarcWriter(dict(self.options), overwrite)


def with_source(spark: SparkSession) -> SparkSession:
    """The session with the data source known and predicate pushdown into Python sources on, unless it is set."""
    prepared(spark)
    spark.dataSource.register(WarcSource)
    if spark.conf.get("spark.sql.python.filterPushdown.enabled", None) in (None, "false"):
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def read_archive(spark: SparkSession, path: str, payload: str = "bytes", mode: str = "failfast") -> DataFrame:
    """The records of the archives below ``path``, or of one file. Filters on its header columns reach the reader."""
    return with_source(spark).read.format("warc").option("payload", payload).option("mode", mode).load(path)


def write_archive(df: DataFrame, folder: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
                  min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """A record for every row, below ``folder``. Of rows with equal payloads of at least ``min_bytes`` bytes, the one
    with the largest id is a response with the payload, and the others are revisits that refer to it.

    A null payload is empty; a null id is smaller than all others and has no id in its record; a null URI
    has no URI. Of rows with equal ids and payloads one, whichever was staged last, is the response.
    Payloads are equal if length, SHA-1 and a second hash are. Rows are staged once, so that their numbers,
    from which record ids are made, hold for both passes; an empty table makes an archive without files.
    """
    spark = with_source(df.sparkSession)
    payload = F.coalesce(df[payload_col].cast("binary"), F.lit(b""))
    rows = df.select(df[id_col].cast("string").alias("document_id"), df[id_col].alias("id"),
                     df[uri_col].cast("string").alias("target_uri"), payload.alias("payload"))
    rows = stage(rows.select("*", F.length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("sha1"),
                             F.xxhash64("payload").alias("second"), F.monotonically_increasing_id().alias("row")),
                 "warc-rows", compression="zstd")
    same = ["payload_bytes", "sha1", "second"]
    narrow = rows.filter(F.col("payload_bytes") >= min_bytes).select("row", "id", *same)
    groups = narrow.groupBy(*same).agg(F.max(F.struct("id", "row")).alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    revisits = join_hot(narrow, groups.select(*same, "n", F.col("top.row").alias("first")), same, "n") \
        .filter("row <> first").select(F.col("row").alias("_row"), "first")
    run = uuid.uuid4().hex
    records = rows.join(revisits, F.col("row") == F.col("_row"), "left").select(
        F.when(F.col("first").isNull(), "response").otherwise("revisit").alias("record_type"),
        record_id("row", run).alias("record_id"), record_id("first", run).alias("refers_to"), "document_id", "target_uri",
        "sha1", "payload_bytes", F.when(F.col("first").isNull(), F.col("payload")).alias("payload"))
    records.write.format("warc").mode("append").option("path", folder).option("filebytes", file_bytes).save()


def record_id(row: str, run: str):  # noqa: ANN201
    """A URN made of the run and a row's number; null where that is null."""
    code = F.md5(F.concat(F.lit(run), F.col(row).cast("string")).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(code, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def resolved(spark: SparkSession, folder: str) -> DataFrame:
    """A row for every response and revisit of an archive: ``document_id``, ``record_type``, ``payload_bytes`` and
    ``payload_sha1`` of the full payload as it was read, and ``refers_to`` (the response's document id, for revisits).

    Responses are read with their payloads, revisits by their header lines alone; a revisit takes what it
    says from the response that it refers to. One whose response is missing keeps nulls.
    """
    responses = stage(read_archive(spark, folder, "digest").filter("record_type = 'response'").select(
        "record_id", "document_id", "record_type", "payload_bytes", "payload_sha1"), "warc-responses")
    revisits = read_archive(spark, folder, "none").filter("record_type = 'revisit'").select(
        "document_id", "record_type", F.col("refers_to").alias("to"))
    times = revisits.groupBy("to").agg(F.count(F.lit(1)).alias("n"))
    known = times.join(responses, F.col("to") == F.col("record_id")).select(
        "to", "n", F.col("document_id").alias("refers_to"), "payload_bytes", "payload_sha1")
    linked = join_hot(revisits, known, ["to"], "n", "left")
    columns = ("document_id", "record_type", "payload_bytes", "payload_sha1", "refers_to")
    return responses.withColumn("refers_to", F.lit(None).cast("string")).select(*columns).unionByName(linked.select(*columns))


def new_folder(df: DataFrame) -> str:
    return scratch_path(df.sparkSession, "warc")

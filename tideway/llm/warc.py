"""WARC archives as a PySpark data source, `spark.read.format("warc")` and `df.write.format("warc")`.

Reading. A partition is a list of files, filled up to `maxPartitionBytes` (option, 128 MB). A file is never cut, since only the record
before tells where a record starts; the writer bounds its files by `maxFileBytes` (option, 256 MB). Of each record the WARC header
is parsed first. Predicates on columns of that header are pushed down and judged there; the block of a record that fails is jumped
over by its length. What is read of the others depends on the columns asked for by `.schema(…)`: without `payload`, at most the HTTP
header. In compressed archives (one gzip member per record) only as much is inflated as is needed, and members that carry their
length (extra field `sl`, which the writer adds) are jumped over too.

Writing (compressed, one gzip member per record, unless the option `compression` is "none") takes record_id, record_type, target_uri, date, refers_to, payload, payload_digest (hexadecimal) and payload_length; missing
columns count as null and others are not looked at. A task writes files of its own names; a manifest that is written once all tasks are done
makes them visible, so lost or repeated tasks leave nothing that is read. Files that came without a manifest are read by their suffix.

Defined results: a null payload of a response is empty; a null URI, date or reference leaves the header out (the date becomes that of the
write). Characters that a header can't hold are percent-encoded. An empty folder, or archives of empty tables, give no response records.
"""

from __future__ import annotations

import base64
import struct
import uuid
import zlib
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull,
    IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SCHEMA = ("file string, offset long, record_id string, record_type string, target_uri string, date string, refers_to string, "
          "payload_digest string, content_type string, content_length long, http_status int, http_length long, "
          "headers map<string,string>, payload binary")
# fixed values: header fields and their columns
FIELDS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "content_type": "content-type",
    "content_length": "content-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value: profile of a revisit
HTTP = "application/http; msgtype=response"
END = b"\r\n\r\n"
CHUNK = 1 << 20        # bytes read at once
FIRST = 2048           # bytes in which most headers end
BATCH_BYTES, BATCH_ROWS = 16 << 20, 4000
PRINTABLE = "".join(chr(c) for c in range(33, 127))


def _place(path: str):
    """File system and path in it, for any scheme that Arrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


# -- records ----------------------------------------------------------------------------------------


def header_text(lines: list[tuple[str, str | None]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None).encode()


def _base32(digest: str | None) -> str | None:
    return digest and "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def encoded(record: dict, now: str) -> bytes:
    """One record, without compression."""
    kind, payload = record.get("record_type") or "response", record.get("payload") or b""
    length = record.get("payload_length")
    http = header_text([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload) if length is None else length))])
    block = b"HTTP/1.1 200 OK\r\n" + http + b"\r\n" + (b"" if kind == "revisit" else payload)
    uri, refers = record.get("target_uri"), record.get("refers_to")
    head = header_text([
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{quote(record.get('record_id') or 'urn:uuid:' + str(uuid.uuid4()), safe=PRINTABLE)}>"),
        ("WARC-Date", record.get("date") or now),
        ("WARC-Target-URI", uri and quote(uri, safe=PRINTABLE)),
        ("WARC-Payload-Digest", _base32(record.get("payload_digest"))),
        ("WARC-Profile", REVISIT if kind == "revisit" else None),
        ("WARC-Refers-To", refers and f"<{quote(refers, safe=PRINTABLE)}>"),
        ("Content-Type", HTTP),
        ("Content-Length", str(len(block))),
    ])
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + END


def info(now: str) -> bytes:
    """The record that opens a file."""
    block = header_text([("software", "tideway"), ("format", "WARC File Format 1.1")])
    head = header_text([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", now),
                        ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + END


def member(record: bytes) -> bytes:
    """The record as a gzip member that tells its own length."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    size = 10 + 14 + len(body) + 8
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    if size >= 1 << 32 or len(record) >= 1 << 32:
        return b"\x1f\x8b\x08\x00\0\0\0\0\0\xff" + body + tail
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(record)) + body + tail


def fields_of(head: bytes) -> dict[str, str]:
    """Names (lower case) and values of a header; a line that starts with a blank continues the one before."""
    fields, name = {}, None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def columns_of(fields: dict[str, str]) -> dict[str, object]:
    row = {c: fields.get(f) for c, f in FIELDS.items()}
    for c in ("record_id", "refers_to"):
        row[c] = row[c] and row[c].removeprefix("<").removesuffix(">")
    row["content_length"] = int(fields["content-length"])
    digest = row["payload_digest"]
    if digest and digest.lower().startswith("sha1:"):
        value = digest[5:]
        row["payload_digest"] = value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()
    return row


# -- predicates ---------------------------------------------------------------------------------------

COMPARED = {
    EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b, In: lambda a, b: a in b, StringStartsWith: str.startswith, StringEndsWith: str.endswith,
    StringContains: lambda a, b: b in a,
}


def predicate(f):
    """The pushed filter as a function from a record's columns to true, false or None (null), or None if it can't be judged by the header."""
    if isinstance(f, Not):
        inner = predicate(f.child)
        return inner and (lambda row: None if (held := inner(row)) is None else not held)
    name = f.attribute[0]
    if len(f.attribute) != 1 or name not in FIELDS:
        return None
    if isinstance(f, IsNull):
        return lambda row: row[name] is None
    if isinstance(f, IsNotNull):
        return lambda row: row[name] is not None
    if isinstance(f, EqualNullSafe):
        return lambda row: row[name] == f.value
    test = COMPARED.get(type(f))
    # `in` with a null among its values is never false
    if test is None or f.value is None or isinstance(f, In) and None in f.value:
        return None
    return lambda row: None if row[name] is None else test(row[name], f.value)


# -- reading ------------------------------------------------------------------------------------------


class Plain:
    """Records of an uncompressed file."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.held = file, size, 0, b""

    def read(self, start: int, n: int) -> bytes:
        """Bytes from `start`; fewer than `n` at the end of the file."""
        if start < self.at or start + n > self.at + len(self.held):
            self.file.seek(start)
            self.at, self.held = start, self.file.read(max(n, CHUNK))
        return self.held[start - self.at:start - self.at + n]

    def records(self):
        """Offset, header, and a function that reads up to n bytes of the block."""
        start = 0
        while start < self.size:
            n = FIRST
            while (end := (head := self.read(start, n)).find(END)) < 0:
                if start + n >= self.size:
                    raise ValueError(f"no end of a header at {start}")
                n *= 4
            block = start + end + len(END)
            fields = fields_of(_checked(head[:end], start))
            length = int(fields["content-length"])
            if block + length > self.size:
                raise ValueError(f"the record at {start} is cut off")
            yield start, fields, lambda n, block=block, length=length: self.read(block, min(n, length))
            start = block + length + len(END)


class Zipped:
    """Records of a file with one gzip member each."""

    def __init__(self, file, size: int):
        self.plain, self.size = Plain(file, size), size

    def _inflate(self, start: int, known: bytearray, state: dict, n: int) -> None:
        """Inflate until `known` holds n bytes or the member ends."""
        while len(known) < n and not state["done"].eof:
            # Plain.read serves small requests from one chunk
            taken = state["left"] or self.plain.read(state["at"], 1 << 14)
            if not taken:
                raise ValueError(f"the record at {start} is cut off")
            state["at"] += 0 if state["left"] else len(taken)
            known += state["done"].decompress(taken, n - len(known))
            state["left"] = state["done"].unconsumed_tail

    def _length(self, start: int) -> int | None:
        """Length of the member, if it tells."""
        head = self.plain.read(start, 12)
        if len(head) < 12 or not head[3] & 4:
            return None
        extra = self.plain.read(start + 12, struct.unpack("<H", head[10:12])[0])
        while len(extra) >= 4:
            name, n = struct.unpack("<2sH", extra[:4])
            if name == b"sl" and n == 8:
                return struct.unpack("<I", extra[4:8])[0]
            extra = extra[4 + n:]
        return None

    def records(self):
        start = 0
        while start < self.size:
            known, state = bytearray(), {"done": zlib.decompressobj(31), "left": b"", "at": start}
            n = FIRST
            while True:
                self._inflate(start, known, state, n)
                if (end := known.find(END)) >= 0:
                    break
                if state["done"].eof:
                    raise ValueError(f"no end of a header at {start}")
                n *= 4
            fields = fields_of(_checked(bytes(known[:end]), start))
            block, length = end + len(END), int(fields["content-length"])

            def read(n, known=known, state=state, block=block, length=length, start=start):
                self._inflate(start, known, state, block + min(n, length))
                return bytes(known[block:block + min(n, length)])

            yield start, fields, read
            told = self._length(start)
            if told is None:
                while not state["done"].eof:
                    known = bytearray()
                    self._inflate(start, known, state, CHUNK)
                told = state["at"] - start - len(state["done"].unused_data)
            start += told


def _checked(head: bytes, start: int) -> bytes:
    if not head.startswith(b"WARC/") or b"content-length:" not in head.lower():
        raise ValueError(f"no record at {start}")
    return head


def records_of(file, size: int, zipped: bool, tests: list, wanted: list[str], name: str):
    """Rows (as dicts) of the records that pass all tests, with the wanted columns."""
    inside = {"payload", "http_status", "http_length"} & set(wanted)
    for offset, fields, block in (Zipped if zipped else Plain)(file, size).records():
        row = columns_of(fields)
        if not all(test(row) for test in tests):
            continue
        row |= {"file": name, "offset": offset, "headers": fields, "http_status": None, "http_length": None, "payload": None}
        if inside:
            length, cut, http = row["content_length"], 0, (row["content_type"] or "").startswith("application/http")
            if http:
                n = FIRST
                while (cut := block(n).find(END)) < 0 and n < length:
                    n *= 4
                cut = length if cut < 0 else cut + len(END)
                head = block(cut)
                status = head.split(b"\r\n", 1)[0].split(b" ")
                row["http_status"] = int(status[1]) if len(status) > 1 and status[1].isdigit() else None
                told = fields_of(head).get("content-length", "")
                row["http_length"] = int(told) if told.isdigit() else None
            if "payload" in wanted:
                row["payload"] = block(length)[cut:]
        yield row


class WarcReader(DataSourceReader):
    def __init__(self, options, schema: StructType):
        self.path, self.schema = options["path"], schema
        self.most = int(options.get("maxPartitionBytes", 128 << 20))
        self.tests = []

    def pushFilters(self, filters):
        for f in filters:
            test = predicate(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)

    def partitions(self):
        groups, held = [[]], 0
        for file, size in files_of(self.path):
            if groups[-1] and held + size > self.most:
                groups.append([])
                held = 0
            groups[-1].append((file, size))
            held += size
        return [InputPartition(g) for g in groups]

    def read(self, partition):
        names, arrow = self.schema.fieldNames(), to_arrow_schema(self.schema)
        system, _ = _place(self.path)
        rows, held = [], 0

        def batch():
            # maps as lists of pairs
            return pa.RecordBatch.from_arrays(
                [pa.array([list(r[n].items()) if isinstance(r[n], dict) else r[n] for r in rows], arrow.field(n).type) for n in names], schema=arrow)

        for file, size in partition.value:
            with system.open_input_file(file) as opened:
                for row in records_of(opened, size, file.endswith(".gz"), self.tests, names, file):
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()


def files_of(path: str) -> list[tuple[str, int]]:
    """Files (path, size) of an archive: those that manifests name, or else all with a known suffix."""
    from pyarrow import fs

    system, inside = _place(path)
    found = system.get_file_info(inside)
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if found.is_file:
        return [(inside, found.size)]
    entries = [e for e in system.get_file_info(fs.FileSelector(inside)) if e.is_file]
    manifests = [e for e in entries if e.base_name.startswith("_written-")]
    if not manifests:
        return sorted((e.path, e.size) for e in entries if e.base_name.endswith((".warc", ".warc.gz")) and e.base_name[0] not in "._")
    listed = []
    for e in manifests:
        with system.open_input_stream(e.path) as opened:
            for line in opened.read().decode().splitlines():
                size, name = line.split(" ", 1)
                listed.append((f"{inside}/{name}", int(size)))
    return sorted(listed)


# -- writing ------------------------------------------------------------------------------------------


class Written(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.zipped = options.get("compression", "gzip") == "gzip"
        self.most = int(options.get("maxFileBytes", 256 << 20))
        self.now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        self.job = uuid.uuid4().hex

    def write(self, iterator):
        system, inside = _place(self.path)
        system.create_dir(inside, recursive=True)
        files, out, size = [], None, 0
        pack = member if self.zipped else bytes
        for batch in iterator:
            for record in batch.to_pylist():
                if out is None:
                    name, size = f"part-{uuid.uuid4().hex}.warc" + (".gz" if self.zipped else ""), 0
                    out = system.open_output_stream(f"{inside}/{name}", compression=None, buffer_size=CHUNK)
                    size += out.write(pack(info(self.now)))
                size += out.write(pack(encoded(record, self.now)))
                if size >= self.most:
                    out.close()
                    files.append((name, size))
                    out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return Written(files)

    def commit(self, messages):
        from pyarrow import fs

        system, inside = _place(self.path)
        system.create_dir(inside, recursive=True)
        before = [e.path for e in system.get_file_info(fs.FileSelector(inside)) if e.is_file and not e.base_name.startswith("part-")]
        old = files_of(self.path) if self.overwrite else []
        with system.open_output_stream(f"{inside}/_written-{self.job}") as out:
            out.write("".join(f"{size} {name}\n" for m in messages if m for name, size in m.files).encode())
        if self.overwrite:
            for path in [*before, *[p for p, _ in old]]:
                system.delete_file(path)

    def abort(self, messages):
        system, inside = _place(self.path)
        for m in messages:
            for name, _ in m.files if m else []:
                system.delete_file(f"{inside}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options, schema)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> SparkSession:
    """Make the format known to the session and let its filters be pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark


# -- pages as records ---------------------------------------------------------------------------------

PAGE = "urn:x-page:"


def page_records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Records to write for pages (page_id, url, html).

    Of pages with equal payloads of at least `least` bytes the one with the largest page_id is a response and the others revisit
    it. A null html is an empty payload. A null page_id counts as the smallest; rows that share the largest id are responses each.
    Payloads are shuffled once, by their SHA-256; a payload that very many pages share is split by adaptive skew joins, as only repeated
    payloads have a row on the other side.
    """
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("target_uri"), body.alias("payload"))
    rows = rows.withColumns({"payload_length": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload"),
                             "_same": F.when(F.octet_length("payload") >= least, F.unhex(F.sha2("payload", 256)))})
    first = (rows.where("_same IS NOT NULL").groupBy("_same").agg(F.max("page_id").alias("_first"), F.count("*").alias("_n"))
             .where("_n > 1").drop("_n"))
    known = rows.join(first, "_same", "left")
    again = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    urn = lambda c: F.concat(F.lit(PAGE), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return known.select(
        urn("page_id").alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.when(again, urn("_first")).alias("refers_to"), F.when(~again, F.col("payload")).alias("payload"), "payload_digest", "payload_length")


def page_index(spark: SparkSession, path: str) -> DataFrame:
    """What the archive says of each page. Payloads of responses are read and measured; of revisits only headers are read."""
    read = lambda schema, kind: spark.read.format("warc").schema(schema).load(path).where(F.col("record_type") == kind)
    page = lambda c: F.substring(c, len(PAGE) + 1, 30).try_cast("long")
    whole = read("record_id string, record_type string, payload binary", "response").select(
        page("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    again = read("record_id string, record_type string, refers_to string, payload_digest string, http_length long", "revisit").select(
        page("record_id").alias("page_id"), F.col("http_length").alias("payload_bytes"), "payload_digest", "record_type",
        page("refers_to").alias("refers_to"))
    return whole.unionByName(again)

"""WARC archives: pages written as records by Spark's text writer, and archives read back.

A record is a line for the writer, whose line end is the two CRLF that close a record. A page is a response with a chunked HTTP body,
or a revisit of an earlier record with the same payload, which has no body. A block longer than ``segment_bytes`` is cut: the first record
has segment number 1, continuation records name it as their origin, and the last of them gives the block's whole length.

Reading takes an archive at a time as a stream, plain or gzip. What belongs to one origin then meets in one task in order of segments, is
checked for gaps and against the whole length, and its transfer framing is decoded as it passes: neither an archive nor a
block is held whole, but where payloads are asked for.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import hidden, small_batches, trimmed

END = b"\r\n\r\n"
SEGMENT_BYTES, CHUNK_BYTES = 16 << 10, 4 << 10
#: So many records go to an archive at most: 128 MB at this segment length, before compression.
MOST_RECORDS = 8192
#: Captures have no time of their own here.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PLACE = "urn:page:"

READ = "record_id string, origin string, segment int, total long, type string, target string, refers_to string, digest string, payload_bytes long, payload_digest string, payload binary, block binary, error string"
FOUND = "record_id string, type string, target string, refers_to string, payload_bytes long, payload_digest string, payload binary, segments int, error string"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- writing


def _cut(data: bytes, most: int) -> Iterator[bytes]:
    """Parts of at most ``most`` bytes, none ending within a character."""
    at = 0
    while at < len(data):
        end = at + most
        if end < len(data):
            while end > at + 1 and end > at + most - 3 and data[end] & 0xC0 == 0x80:
                end -= 1
        yield data[at:end]
        at = end


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def _uri(url: str | None, otherwise: str) -> str:
    """A URI for a header line: control characters and spaces as escapes."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url) if url else otherwise


def records_of(name: str, url: str | None, payload: bytes, first: str | None, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> Iterator[bytes]:
    """The records of one page, without their closing line ends: a revisit of the record ``first``, or a response in as many segments as it takes."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    common = [("WARC-Target-URI", _uri(url, f"{PLACE}{name}")), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}")]
    kind = ("Content-Type", "application/http;msgtype=response")
    ident = ("WARC-Record-ID", f"<{PLACE}{name}>")
    if first is not None:
        block = head + f"Content-Length: {len(payload)}".encode() + END
        yield _record([("WARC-Type", "revisit"), ident, *common, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{PLACE}{first}>"), kind], block)
        return
    chunks = b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in _cut(payload, chunk_bytes))
    block = head + b"Transfer-Encoding: chunked" + END + chunks + b"0" + END
    parts = list(_cut(block, segment_bytes))
    cut = [("WARC-Segment-Number", "1")] if len(parts) > 1 else []
    yield _record([("WARC-Type", "response"), ident, *common, *cut, kind], parts[0])
    for k, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", str(len(block)))] if k == len(parts) else []
        fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{PLACE}{name}:{k}>"), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", ident[1]), ("WARC-Segment-Number", str(k)), *last]
        yield _record(fields, part)


def _writer(segment_bytes: int, chunk_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, url, payload, first in zip(*[b.column(c) for c in ("name", "url", "payload", "first")], strict=True):
                rows = list(records_of(name.as_py(), url.as_py(), payload.as_py(), first.as_py(), segment_bytes, chunk_bytes))
                # As they are: the writer puts out bytes, and a text may hold some that aren't UTF-8.
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()).view(pa.string())], names=["record"])

    return trimmed(write)


def captures(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """name, url, payload, first: what each page's record is called, and the record that it revisits, if it does.

    Of rows with equal payloads of at least ``least`` bytes, one with the smallest id is the response. Who that is gets worked out on
    hashes; payloads move once, by id and hash, so that a page copied many times doesn't end in one task.
    """
    columns, _ = hidden(pages, [page_id, url, html])
    rows = pages.select(*columns).select(F.col("__c0").alias("id"), F.col("__c1").cast("string").alias("url"), F.coalesce(F.col("__c2").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("hash", F.sha2("payload", 256))
    known = rows.where("id IS NOT NULL")
    small = known.select("id", "hash", F.octet_length("payload").alias("n")).where(F.col("n") >= least)
    firsts = small.groupBy("hash").agg(F.min("id").alias("first"), F.count("*").alias("copies")).where("copies > 1").select("hash", "first")
    roles = small.groupBy("id", "hash").agg(F.lit(1)).join(firsts, "hash").select(F.col("id").alias("i"), F.col("hash").alias("h"), "first")
    placed = known.join(roles, (F.col("id") == F.col("i")) & (F.col("hash") == F.col("h")), "left").drop("i", "h")
    placed = placed.withColumn("copy", F.row_number().over(Window.partitionBy("id", "hash").orderBy("url")))
    mark = F.substring("hash", 1, 16)
    named = lambda i, copy: F.concat_ws(":", i.cast("string"), mark, copy.cast("string"))
    again = F.col("first").isNotNull() & ((F.col("first") != F.col("id")) | (F.col("copy") > 1))
    placed = placed.select(named(F.col("id"), F.col("copy")).alias("name"), "url", "payload", F.when(again, named(F.col("first"), F.lit(1))).alias("first"))
    nameless = rows.where("id IS NULL").select(F.concat_ws(":", F.lit("none"), mark, F.monotonically_increasing_id().cast("string")).alias("name"), "url", "payload", F.lit(None).cast("string").alias("first"))
    return placed.unionByName(nameless)


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> None:
    """A record for each page under a path: see ``captures`` and ``records_of``.

    A null text is empty, a null url is named after the record, rows that repeat are revisits of the first, rows without an id are
    responses that nothing refers to; ids are cast to strings; other columns are left alone; no pages, no records.
    """
    small_batches(pages.sparkSession)
    rows = captures(pages, page_id, url, html, least).mapInArrow(_writer(segment_bytes, chunk_bytes), "record string")
    rows.write.mode("overwrite").option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", MOST_RECORDS).text(path)


# ---- reading


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by lower-case name, block) of each record of an archive; raises ValueError where it isn't one or ends too early."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields: dict[str, str] = {}
        name = ""
        while (line := stream.readline()).strip():
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[0] in " \t" and name:  # a folded line goes on
                fields[name] += f" {text.strip()}"
                continue
            name, _, value = text.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
        length = int(fields.get("content-length", "-1"))
        block = stream.read(length) if length >= 0 else b""
        if length < 0 or len(block) < length:
            raise ValueError(f"record {fields.get('warc-record-id')} has {len(block)} bytes, not {length}")
        yield fields, block


class Payload:
    """An HTTP message that comes in parts: its body's bytes and SHA-1, decoded from chunks where its head says so."""

    def __init__(self, keep: bool = False):
        self.head, self.body, self.framed, self.left, self.rest = b"", [] if keep else None, False, None, b""
        self.length, self.digest, self.over, self.error, self.stated = 0, hashlib.sha1(), False, None, None

    def _said(self, head: bytes) -> None:
        for line in head.split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            name, value = name.strip().lower(), value.strip().lower()
            if name == b"transfer-encoding":
                self.framed = value.split(b",")[-1].strip() == b"chunked"
            elif name == b"content-length" and value.isdigit():
                self.stated = int(value)

    def _take(self, data: bytes) -> None:
        self.length += len(data)
        self.digest.update(data)
        if self.body is not None:
            self.body.append(data)

    def feed(self, data: bytes) -> None:
        if self.head is not None:
            self.head += data
            end = self.head.find(END)
            if end < 0:
                return
            self._said(self.head[:end])
            data, self.head = self.head[end + 4 :], None
        if not self.framed:
            self._take(data)
            return
        self.rest += data
        at = 0
        while not self.over and self.error is None:
            if self.left is None:  # a line with the next chunk's size
                end = self.rest.find(b"\r\n", at)
                if end < 0:
                    break
                size = self.rest[at:end].split(b";")[0].strip()
                if re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
                    self.left = int(size, 16)
                else:
                    self.error = f"no chunk has the size {size[:20]!r}"
                    break
                at, self.over = end + 2, self.left == 0  # what follows the last chunk are trailers
            take = self.rest[at : at + self.left]
            self._take(take)
            at, self.left = at + len(take), self.left - len(take)
            if self.left or len(self.rest) < at + 2:
                break
            if not self.over and self.rest[at : at + 2] != b"\r\n":
                self.error = "a chunk doesn't end where its size says"
            at, self.left = at + 2, None
        self.rest = self.rest[at:]

    def end(self) -> str | None:
        """What is wrong with the message, if anything."""
        if self.error is None and self.head is not None:
            self.error = "the head has no end"
        if self.error is None and self.framed and not self.over:
            self.error = "the last chunk is missing"
        return self.error


def _number(fields: dict[str, str], name: str) -> int | None:
    value = fields.get(name)
    return int(value) if value is not None and value.isdigit() else None


def _told(fields: dict[str, str], message: Payload, keep: bool) -> tuple:
    """(payload_bytes, payload_digest, payload, error) of a record whose block is complete; a revisit's are those that its fields state."""
    wrong = message.end()
    stated = fields["digest"]
    if fields["type"] == "revisit":
        return message.stated, stated, None, wrong
    digest = base64.b32encode(message.digest.digest()).decode()
    if wrong is None and stated and stated != digest:
        wrong = f"the payload has the digest {digest}, not {stated}"
    return message.length, digest, b"".join(message.body) if keep else None, wrong


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _reader(keep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Archives -> records: those in one piece decoded, the others' blocks as they are."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(READ)
        for b in batches:
            for path, content in zip(b.column("path"), b.column("content"), strict=True):
                data = pa.BufferReader(content.as_buffer())
                stream = gzip.GzipFile(fileobj=data) if content.as_buffer()[:2].to_pybytes() == b"\x1f\x8b" else io.BufferedReader(data)
                rows, size = [], 0
                try:
                    for fields, block in records(stream):
                        get = fields.get
                        digest = (get("warc-payload-digest") or "").removeprefix("sha1:") or None
                        ident, kind = (get("warc-record-id") or "").strip("<>"), get("warc-type")
                        about = {"type": kind, "digest": digest}
                        segment = _number(fields, "warc-segment-number")
                        told, rest = (None, None, None, None), block
                        if segment is None and kind in ("response", "revisit"):
                            message = Payload(keep)
                            message.feed(block)
                            told, rest = _told(about, message, keep), None
                        origin = (get("warc-segment-origin-id") or ident).strip("<>") if segment else ident
                        refers = get("warc-refers-to")
                        payload_bytes, payload_digest, payload, error = told
                        rows.append((ident, origin, segment, _number(fields, "warc-segment-total-length"), kind, get("warc-target-uri"), refers.strip("<>") if refers else None, digest, payload_bytes, payload_digest, payload, rest, error))
                        size += len(block)
                        if size > 4 << 20:
                            yield _rows(rows, schema)
                            rows, size = [], 0
                except (ValueError, EOFError, gzip.BadGzipFile) as e:
                    raise ValueError(f"{path.as_py()}: {e}") from e
                if rows:
                    yield _rows(rows, schema)

    return trimmed(read)


class _Origin:
    """The segments of one block, as they come in order."""

    def __init__(self, row: dict, keep: bool):
        self.row, self.keep, self.next, self.length, self.total, self.error = row, keep, 1, 0, None, None
        self.message = Payload(keep)

    def add(self, row: dict) -> None:
        if row["segment"] == self.next - 1:  # read twice
            return
        if self.error is None and row["segment"] != self.next:
            self.error = f"segment {self.next} is missing"
        self.next = row["segment"] + 1
        self.length += len(row["block"])
        if row["total"] is not None:
            self.total = row["total"]
        if self.error is None:
            self.message.feed(row["block"])

    def done(self) -> tuple:
        if self.error is None and self.total != self.length:
            self.error = "the last segment is missing" if self.total is None else f"the segments have {self.length} bytes, not {self.total}"
        told = _told(self.row, self.message, self.keep) if self.error is None else (None, None, None, self.error)
        first = self.row if self.row["segment"] == 1 else {"type": None, "target": None, "refers_to": None}
        return (self.row["origin"], first["type"], first["target"], first["refers_to"], *told[:3], self.next - 1, told[3])


def _assembler(keep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Records sorted by origin and segment -> one row for each origin."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, now = _arrow(FOUND), None
        for b in batches:
            rows = []
            for r in b.to_pylist():
                if now is not None and (r["segment"] is None or r["origin"] != now.row["origin"]):
                    rows.append(now.done())
                    now = None
                if r["segment"] is None:
                    rows.append((r["record_id"], r["type"], r["target"], r["refers_to"], r["payload_bytes"], r["payload_digest"], r["payload"], 1, r["error"]))
                    continue
                if now is None:
                    now = _Origin(r, keep)
                now.add(r)
            if rows:
                yield _rows(rows, schema)
        if now is not None:
            yield _rows([now.done()], schema)

    return trimmed(read)


def read_archives(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """record_id, type, target, refers_to, payload_bytes, payload_digest, payload, segments, error: one row for each record of the archives
    under a path, continuation records put together with their origin.

    ``payload`` is filled where asked for, and then moves with the records; else only the blocks of records in several segments do.
    ``error`` says what is wrong with a record: a segment, the whole length, the framing or the digest. Segments read twice count once.
    Records that aren't HTTP captures have neither bytes nor digest. A file that isn't an archive fails, with its name.
    """
    small_batches(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    rows = files.mapInArrow(_reader(payload), READ)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = rows.repartition(n, "origin").sortWithinPartitions("origin", F.col("segment").asc_nulls_first())
    return met.mapInArrow(_assembler(payload), FOUND)


def page_of(record_id: str) -> Column:
    """The page's id in the name of a record."""
    return F.regexp_extract(record_id, f"^{PLACE}(.*?):", 1)

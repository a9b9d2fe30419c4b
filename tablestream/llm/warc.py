"""Legacy web archives (ARC, versions 1 and 2) to WARC 1.1, and both read back.

An ARC file starts with a version block, whose body names the version of all the
header lines that follow; a record is a header line, the declared number of bytes
and a newline::

    1  URL IP-address Archive-date Content-type Archive-length
    2  URL IP-address Archive-date Content-type Result-code Checksum Location Offset
       Filename Archive-length

Records are found by declared length alone, so a body may hold anything. The
conversion synthesises what ARC lacks: a record id (a version 5 UUID of archive and
place), an ISO date, the record type and SHA-1 digests of block and payload. A
payload that an earlier page already has becomes a ``revisit`` of it.

Files are written by Spark's text writer, which puts the bytes of a value as they
are and then the line separator, here the one the format asks for between records,
and are gzip members as a whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.llm.common import Batches, arrow, settle
from tablestream.session import fresh_path

#: Fixed values of the two formats.
FIELDS = {
    b"1": "url ip date type length".split(),
    b"2": "url ip date type code checksum location offset filename length".split(),
}
ID_HEADER = b"X-Page-Id"
WARC = b"WARC/1.1"

ARC_ROWS = (
    "url string, ip string, date string, type string, archive string, place bigint, body binary"
)
WARC_ROWS = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, "
    "payload_digest string, head binary, payload binary"
)


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema
    )


def _schema(ddl: str) -> pa.Schema:
    types = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, types[t]) for n, t in (f.split() for f in ddl.split(", "))])


def _one_word(text: str) -> bytes:
    """A header field holds no blank or control character: they are percent-encoded."""
    return b"".join(
        b"%%%02X" % c if c <= 0x20 or c == 0x7F else bytes([c]) for c in text.encode()
    )


def arc_record(version: bytes, fields: dict[str, bytes], body: bytes) -> bytes:
    given = fields | {"length": str(len(body)).encode()}
    return b" ".join(given.get(name, b"-") for name in FIELDS[version]) + b"\n" + body


def arc_opening(version: bytes, name: str) -> bytes:
    titles = "URL IP-address Archive-date Content-type"
    if version == b"2":
        titles += " Result-code Checksum Location Offset Filename"
    body = version + b" 0 tablestream\n" + f"{titles} Archive-length\n".encode()
    # Written in the short form whatever the version: it is what says the version.
    fields = {"url": b"filedesc://" + name.encode(), "ip": b"0.0.0.0", "date": b"20240101000000"}
    return arc_record(b"1", fields | {"type": b"text/plain"}, body)


def write_arc(pages: DataFrame, target: str) -> None:
    """Pages as ARC files, a file per input partition, versions 1 and 2 in turn.

    The body is an HTTP response whose head carries the page's id.
    """

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        version = b"12"[part % 2 : part % 2 + 1]
        out = [arc_opening(version, f"part-{part:06d}.arc")]
        for batch in batches:
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (html or "").encode()
                number = b"" if page is None else str(page).encode()
                body = b"\r\n".join(
                    [
                        b"HTTP/1.1 200 OK",
                        b"Content-Type: text/html; charset=utf-8",
                        ID_HEADER + b": " + number,
                        b"Content-Length: " + str(len(payload)).encode(),
                        b"",
                        payload,
                    ]
                )
                fields = {
                    "url": _one_word(url or "urn:page:" + number.decode()),
                    "ip": b"0.0.0.0",
                    "date": b"20240101000000",
                    "type": b"text/html",
                    "code": b"200",
                    "checksum": sha1(payload).encode(),
                    "filename": f"part-{part:06d}.arc".encode(),
                }
                out.append(arc_record(version, fields, body))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
            out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    rows = pages.select(
        pages["page_id"].cast("bigint").alias("page"),
        pages["url"].cast("string").alias("url"),
        pages["html"].cast("string").alias("html"),
    )
    (
        arrow(rows, step, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("compression", "gzip")
        .option("lineSep", "\n")
        .text(target)
    )


class Unzipped:
    """A gzip file of any number of members, read in bounded pieces."""

    def __init__(self, content: bytes) -> None:
        self.rest, self.buffer, self.at = memoryview(content), bytearray(), 0
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        if not len(self.rest):
            return False
        piece, self.rest = self.rest[: 1 << 18], self.rest[1 << 18 :]
        while len(piece):
            self.buffer += self.inflate.decompress(piece)
            piece = self.inflate.unused_data if self.inflate.eof else b""
            if self.inflate.eof:
                self.inflate = zlib.decompressobj(31)
        return True

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        if len(self.buffer) < n:
            raise ValueError("an archive ends inside a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        self.at += n
        return out

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with ``mark``; None at the end of the file."""
        seen = 0
        while (found := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if not self._more():
                if self.buffer:
                    raise ValueError("an archive ends inside a header")
                return None
        return self.take(found + len(mark))


def arc_records(content: bytes) -> Iterator[tuple[int, dict[str, bytes], bytes]]:
    """Place, header fields and body of each record behind the version block."""
    file = Unzipped(content)
    line = file.until(b"\n")
    if line is None:
        return
    body = file.take(int(line.split()[-1]))
    version = body.split(b" ", 1)[0]
    if not line.startswith(b"filedesc://") or version not in FIELDS:
        raise ValueError("not an ARC file of version 1 or 2")
    file.take(1)
    names = FIELDS[version]
    while (at := file.at, line := file.until(b"\n"))[1] is not None:
        values = line.split()
        if len(values) != len(names):
            raise ValueError(f"a version {version.decode()} header has {len(names)} fields: {line!r}")
        fields = dict(zip(names, values, strict=True))
        yield at, fields, file.take(int(fields["length"]))
        file.take(1)


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        schema = _schema(ARC_ROWS)
        for batch in batches:
            for name, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = []
                for at, f, body in arc_records(content):
                    head = tuple(f[k].decode() for k in ("url", "ip", "date", "type"))
                    rows.append((*head, name, at, body))
                    if len(rows) == 500:
                        yield _batch(rows, schema)
                        rows = []
                yield _batch(rows, schema)

    return arrow(_files(spark, path), step, ARC_ROWS)


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """Head with its blank line, and payload; a body without a head is all payload."""
    end = body.find(b"\r\n\r\n") if body.startswith(b"HTTP/") else -5
    return body[: end + 4] if end >= 0 else b"", body[end + 4 :] if end >= 0 else body


def page_of(head: bytes) -> int | None:
    found = re.search(rb"(?mi)^" + ID_HEADER + rb": (-?[0-9]+)\r?$", head)
    return int(found[1]) if found else None


def payload_keys(records: DataFrame) -> DataFrame:
    """``page, digest, archive, place`` of each record, without its payload."""

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        schema = _schema("page bigint, digest string, archive string, place bigint")
        for batch in batches:
            rows = []
            for body, archive, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                head, payload = split_http(body)
                rows.append((page_of(head), sha1(payload), archive, place))
            yield _batch(rows, schema)

    return arrow(
        records.select("body", "archive", "place"),
        step,
        "page bigint, digest string, archive string, place bigint",
    )


def first_pages(keys: DataFrame) -> DataFrame:
    """``archive, place, refers_to``: null for the page that others refer to.

    The smallest page id of equal payloads is the original; of repeated rows with
    that id, the first by archive and place. A payload whose pages all lack an id is
    no original for others.
    """
    where = F.struct(F.col("page"), F.col("archive"), F.col("place"))
    first = keys.where("page IS NOT NULL").groupBy("digest").agg(F.min(where).alias("first"))
    is_first = (F.col("first.archive") == F.col("archive")) & (
        F.col("first.place") == F.col("place")
    )
    return keys.join(first, "digest", "left").select(
        "archive", "place", F.when(~is_first, F.col("first.page")).alias("refers_to")
    )


def iso_date(date: str) -> str:
    """The 14 digits of ARC (shorter ones filled up) as an ISO time in UTC."""
    d = re.sub(r"\D", "", date)[:14]
    d += "00000101000000"[len(d) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(fields: dict[str, str], block: bytes) -> bytes:
    lines = [WARC, *(f"{k}: {v}".encode() for k, v in fields.items())]
    return b"\r\n".join([*lines, b"Content-Length: %d" % len(block), b"", block])


def record_id(archive: str, place: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'arc:{archive}#{place}')}>"


def convert(records: DataFrame, firsts: DataFrame, target: str) -> None:
    """ARC records as WARC files."""

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for url, ip, date, kind, archive, place, body, refers in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                head, payload = split_http(body)
                block = body if refers is None else head
                fields = {
                    "WARC-Type": "response" if refers is None else "revisit",
                    "WARC-Record-ID": record_id(archive, place),
                    "WARC-Date": iso_date(date),
                    "WARC-Target-URI": url,
                    "WARC-IP-Address": ip,
                    "WARC-Payload-Digest": "sha1:" + sha1(payload),
                    "WARC-Block-Digest": "sha1:" + sha1(block),
                    "Content-Type": "application/http;msgtype=response" if head else kind,
                }
                if refers is not None:
                    fields["WARC-Profile"] = (
                        "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                    )
                    fields["WARC-Refers-To-Page"] = str(refers)
                out.append(warc_record(fields, block))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    rows = records.join(firsts, ["archive", "place"]).select(
        "url", "ip", "date", "type", "archive", "place", "body", "refers_to"
    )
    (
        arrow(rows, step, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("compression", "gzip")
        .option("lineSep", "\r\n\r\n")
        .text(target)
    )


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    file = Unzipped(content)
    while (raw := file.until(b"\r\n\r\n")) is not None:
        version, *lines = raw[:-4].split(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version!r}")
        fields = dict(line.decode().split(": ", 1) for line in lines)
        block = file.take(int(fields["Content-Length"]))
        if fields.get("WARC-Block-Digest", "sha1:" + sha1(block)) != "sha1:" + sha1(block):
            raise ValueError(f"{fields['WARC-Record-ID']} is damaged")
        yield fields, block
        if file.take(4) != b"\r\n\r\n":
            raise ValueError("a record is longer than it declares")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        schema = _schema(WARC_ROWS)
        for batch in batches:
            for content in batch.column(1).to_pylist():
                rows = []
                for f, block in warc_records(content):
                    names = "WARC-Record-ID WARC-Type WARC-Target-URI WARC-Date"
                    rows.append(
                        (
                            *(f.get(k) for k in names.split()),
                            f.get("WARC-Refers-To-Page"),
                            f["WARC-Payload-Digest"].removeprefix("sha1:"),
                            *split_http(block),
                        )
                    )
                    if len(rows) == 500:
                        yield _batch(rows, schema)
                        rows = []
                yield _batch(rows, schema)

    return arrow(_files(spark, path), step, WARC_ROWS)


def summaries(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    The length is what the HTTP head declares: a revisit has no payload of its own.
    A response's declared length and digest are tested against its payload.
    """

    def step(batches: Batches) -> Iterator[pa.RecordBatch]:
        schema = _schema(SUMMARY)
        for batch in batches:
            rows = []
            for head, payload, digest, kind, refers in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                size = int(re.search(rb"(?mi)^Content-Length: ([0-9]+)\r?$", head)[1])
                if kind == "response" and (size, digest) != (len(payload), sha1(payload)):
                    raise ValueError(f"the payload of page {page_of(head)} is damaged")
                rows.append((page_of(head), size, digest, kind, refers and int(refers)))
            yield _batch(rows, schema)

    picked = records.select("head", "payload", "payload_digest", "record_type", "refers_to")
    return arrow(picked, step, SUMMARY)


SUMMARY = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint"
)


def archive(pages: DataFrame) -> DataFrame:
    """Pages to ARC, ARC to WARC, and what the WARC files say.

    Null html is the empty payload, a null url a ``urn:page`` one; repeated rows are
    records of their own; columns beyond page_id, url and html are not kept.
    """
    spark = pages.sparkSession
    legacy, target = fresh_path(spark, "arc"), fresh_path(spark, "warc")
    write_arc(pages, legacy)
    records = read_arc(spark, legacy)
    firsts = first_pages(settle(payload_keys(records), "payload-keys"))
    convert(records, firsts, target)
    return summaries(read_warc(spark, target))

"""WARC archives: a writer with revisit records and a splittable reader.

Writing: of the records with equal payloads of a least size the one with the
largest id becomes the response and the others refer to it. Only digests are
grouped, with map-side aggregation. Each record is one gzip member. Spark's own
text writer puts the members into files, so a retried task leaves no half file
and any store that Spark writes to will do: it ends each row with a zero byte,
which is the last byte of a member anyway (the high byte of its length; where
it is not, an empty member follows).

Reading: files are listed with their lengths and cut into byte ranges, which
tasks take independently. A task looks for the gzip magic in its range, decodes
a candidate to its end and accepts it only if its checksum holds and it is a
whole WARC record; from there it follows the members one by one. It owns the
records that start inside its range, and reads on past the end to finish the
last. Archive files are opened with pyarrow's file systems, so they must be in
a store that all executors reach.

Defined results: null html is an empty payload; null ids are written as such
and sort below all others; equal largest ids are all responses; a null url
leaves the target out; an empty table writes no records; extra page columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.llm.shared import require, utf8

MIN_REVISIT_BYTES = 1000
SPLIT_BYTES = 8 << 20
GZIP_MAGIC = b"\x1f\x8b\x08"
GZIP = 31  # window bits that ask zlib for a gzip wrapper
READ_BYTES = 1 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD = (
    "path string, offset bigint, warc_type string, record_id string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes bigint, payload binary"
)


def with_revisits(pages: DataFrame, least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest, payload_bytes and refers_to (null: a response)."""
    require(pages, "page_id", "url", "html")
    payload = utf8("html")
    rows = pages.select("page_id", "url", payload.alias("payload")).select(
        "*", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("payload_bytes")
    )
    key = ["digest", "payload_bytes"]
    same = rows.filter(F.col("payload_bytes") >= least).groupBy(*key).agg(
        F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    joined = rows.join(same.filter("n > 1").drop("n"), key, "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.withColumn("refers_to", refers).drop("first")


def _header(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_uri(page_id: object) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}"]
    return ("WARC/1.0\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    """A gzip member without time and name; its last byte is zero."""
    press = zlib.compressobj(level, zlib.DEFLATED, GZIP)
    out = press.compress(data) + press.flush()
    if out[-1]:
        press = zlib.compressobj(level, zlib.DEFLATED, GZIP)
        out += press.flush()
    return out


def page_record(page_id, url, payload: bytes, digest: str, refers_to, date: str = DATE) -> bytes:
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = [("WARC-Record-ID", record_uri(page_id)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", _header(url)))
    headers.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_uri(refers_to))]
    headers.append(("Content-Type", "application/http;msgtype=response"))
    block = http.encode() + (b"" if revisit else payload)
    return _record("revisit" if revisit else "response", headers, block)


def write_warc(pages: DataFrame, folder: str, least: int = MIN_REVISIT_BYTES, level: int = 6, date: str = DATE) -> None:
    """Write one record per page below ``folder``, one archive file per task."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        about = _record("warcinfo", [("WARC-Record-ID", "<urn:info>"), ("WARC-Date", date)], b"format: WARC File Format 1.0\r\n")
        yield pa.RecordBatch.from_arrays([pa.array([_member(about, level)[:-1]], pa.binary())], ["member"])
        for batch in batches:
            made, size = [], 0
            for i in range(batch.num_rows):
                made.append(_member(page_record(*[c[i].as_py() for c in batch.columns], date=date), level)[:-1])
                size += len(made[-1])
                if size > READ_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["member"])
                    made, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["member"])

    rows = with_revisits(pages, least).select("page_id", "url", "payload", "digest", "refers_to")
    out = rows.mapInArrow(members, "member binary").select(F.col("member").cast("string").alias("value"))
    out.write.option("lineSep", "\0").text(folder)


class Source:
    """Bytes of one file, read on demand in pieces."""

    def __init__(self, path: str) -> None:
        from pyarrow import fs

        uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path
        store, inner = fs.FileSystem.from_uri(uri)
        self.file = store.open_input_file(inner)
        self.start, self.held = 0, b""

    def at(self, offset: int, size: int) -> bytes:
        """Up to ``size`` bytes from ``offset``; fewer only at the end of the file."""
        if not self.start <= offset or offset + size > self.start + len(self.held):
            self.file.seek(offset)
            self.start, self.held = offset, self.file.read(max(size, READ_BYTES))
        return self.held[offset - self.start : offset - self.start + size]

    def close(self) -> None:
        self.file.close()


def _whole_member(source: Source, offset: int, need_magic: bool) -> tuple[bytes, int] | None:
    """The member at ``offset`` decoded, and where it ends; None if there is none.

    ``need_magic`` is for candidates: they are given up as soon as what they
    decode to does not begin as a WARC record.
    """
    plain, at = [], offset
    press = zlib.decompressobj(GZIP)
    first = True
    while not press.eof:
        piece = source.at(at, 1 << 16)
        if not piece:
            return None
        try:
            plain.append(press.decompress(piece))
        except zlib.error:
            return None
        at += len(piece)
        if first and plain[0]:
            first = False
            if need_magic and not b"WARC/1.".startswith(plain[0][:7]):
                return None
    return b"".join(plain), at - len(press.unused_data)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """Headers (names in lower case) and block, if the bytes are one whole record."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"WARC/1."):
        return None
    headers = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = headers.get("content-length", "")
    if not size.isdigit() or "warc-type" not in headers:
        return None
    size = int(size)
    if len(rest) < size or rest[size:].strip(b"\r\n"):
        return None
    return headers, rest[:size]


def _payload(headers: dict[str, str], block: bytes) -> tuple[bytes, int]:
    """The payload held and the length of the full one, by the HTTP header."""
    if not headers.get("content-type", "").startswith("application/http"):
        return block, len(block)
    head, _, body = block.partition(b"\r\n\r\n")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return body, int(value)
    return body, len(body)


def owned_records(source: Source, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of the records that start in [start, end)."""
    at, known = start, start == 0
    while at < end:
        if not known:
            window = source.at(at, min(end - at, READ_BYTES) + len(GZIP_MAGIC) - 1)
            found = window.find(GZIP_MAGIC)
            if found < 0:
                at += max(len(window) - len(GZIP_MAGIC) + 1, 1)
                continue
            at += found
            if at >= end:
                return
        member = _whole_member(source, at, not known)
        record = parse_record(member[0]) if member and member[0] else None
        if member and (record or (known and not member[0])):
            if record:
                yield at, *record
            at, known = member[1], True
        elif known and not source.at(at, 1):
            return
        else:
            # a false candidate, or a damaged member: look for the next one
            at, known = at + 1, False


def read_warc(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records below ``folder``: path, offset, type, ids, digest, full payload length and payload."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    splits = files.filter("length > 0").select("path", "length", F.explode(starts).alias("start"))
    splits = splits.withColumn("end", F.least(F.col("length"), F.col("start") + split_bytes)).drop("length")
    schema = pa.schema(
        [(n, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[t]) for n, t in map(str.split, RECORD.split(", "))]
    )

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                source = Source(split["path"])
                rows, size = [], 0
                try:
                    for offset, headers, block in owned_records(source, split["start"], split["end"]):
                        payload, full = _payload(headers, block)
                        rows.append(
                            {
                                "path": split["path"],
                                "offset": offset,
                                "warc_type": headers["warc-type"],
                                "record_id": headers.get("warc-record-id"),
                                "target_uri": headers.get("warc-target-uri"),
                                "refers_to": headers.get("warc-refers-to"),
                                "payload_digest": headers.get("warc-payload-digest"),
                                "payload_bytes": full,
                                "payload": payload,
                            }
                        )
                        size += len(payload)
                        if size > READ_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                finally:
                    source.close()
                yield pa.RecordBatch.from_pylist(rows, schema)

    # one task per few splits: the listing itself is tiny
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return splits.repartition(parts, "path", "start").mapInArrow(take, RECORD)

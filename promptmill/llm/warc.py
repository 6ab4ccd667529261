"""WARC archives of pages, and a salvage reader.

Writing.  Each record is a gzip member of its own, and Spark's text sink writes the members as rows: its commit protocol
makes lost and repeated tasks harmless, and it writes to any store Spark knows.  The sink's line separator is an empty
gzip member, so a file is a plain sequence of members that any gzip or WARC reader takes.  A page whose payload, of at
least ``LEAST`` bytes, a smaller page_id has too becomes a revisit record: its block holds the HTTP header alone.

Reading.  A file's members (or, uncompressed, its version lines) are read one after the other.  A record counts if the
member's checksum, its header lines, its length and, for responses, the payload digest hold.  After a failed check the
reader searches for the next position from which a record can be read whole, goes on there, and logs the bytes between as
a quarantined gap with the reason.  Revisits keep the length and digest of the full payload in their headers.

Joins carry ids and digests; a payload held by very many pages is one row on the small side, and Spark splits the
large side.  Files are cut by bytes (``ROW_BYTES``).
A salvage search looks at each stretch once: it goes on from the next mark that is already known.

Defined results: null html is the empty payload; equal payloads under LEAST bytes are all responses; rows that repeat
the smallest page_id are responses too; a null page_id is never the smallest, and pages that have no other share the
payload stay responses; extra columns are not read; an empty table gives no record.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.llm.common import arrow_schema, slices
from promptmill.session import scratch_path

LEAST = 100
# a header has no longer line and no more fields
LONGEST_VERSION, LONGEST_LINE, MOST_FIELDS = 16, 1 << 20, 100
# members are joined to rows of about ROW_BYTES, and a file holds at most ROWS_A_FILE of them
ROW_BYTES, ROWS_A_FILE = 256 << 10, 64
# Fixed values of the formats: version line, ends of lines and records, start of a gzip member, an empty member.
VERSION, LINE, END, MEMBER = b"WARC/1.1", b"\r\n", b"\r\n\r\n", b"\x1f\x8b\x08"
EMPTY_MEMBER = bytes([31, 139, 8, 0, 0, 0, 0, 0, 0, 255, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0])
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One uncompressed record; the payload is left out of a revisit."""
    http = LINE.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload)]) + END
    block = http if refers_to is not None else http + payload
    uri = "".join(c if " " < c < "\x7f" else "".join(f"%{x:02X}" for x in c.encode()) for c in url or "urn:none")
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {uri} {digest}')}>",
        "WARC-Date": DATE, "WARC-Target-URI": uri, "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response", "X-Page-ID": "" if page_id is None else str(page_id)}
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "X-Refers-To-Page-ID": str(refers_to)}
    head["Content-Length"] = str(len(block))
    return VERSION + LINE + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + LINE + block + END


def write(pages: DataFrame, path: str, least: int = LEAST, level: int = 1, row_bytes: int = ROW_BYTES, rows_a_file: int = ROWS_A_FILE) -> None:
    """Archives of ``pages`` (page_id long, url, html), of about ``row_bytes * rows_a_file`` each if no record is longer, in a new folder ``path``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    first = (rows.filter(F.octet_length("html") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select("digest", "first"))
    rows = rows.join(first, "digest", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in slices(batches, 64):
            digest, page, url, html, first = (b.column(b.schema.names.index(n)).to_pylist() for n in ("digest", "page_id", "url", "html", "first"))
            made = [gzip.compress(record(p, u, h.encode(), d, None if f is None or f == p else f), level, mtime=0)
                    for d, p, u, h, f in zip(digest, page, url, html, first)]
            for member in made:
                if held and size + len(member) > row_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["member"])
                    held, size = [], 0
                held.append(member)
                size += len(member)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["member"])

    members = rows.mapInArrow(run, "member binary")
    # a cast of bytes to string keeps the bytes as they are, and the sink writes them so
    (members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", EMPTY_MEMBER.decode("latin-1"))
     .option("encoding", "ISO-8859-1").option("maxRecordsPerFile", rows_a_file).text(path))


class Marks:
    """Places of marks in the data, asked for from rising places: each stretch is searched once."""

    def __init__(self, data: bytes):
        self.data, self.known = data, {}

    def next(self, mark: bytes, at: int) -> int:
        """The first place of ``mark`` at or after ``at``, the end of the data if there is none."""
        place = self.known.get(mark, -1)
        if place < at:
            place = self.data.find(mark, at)
            place = self.known[mark] = len(self.data) if place < 0 else place
        return place


def _header(data: bytes, start: int) -> tuple[dict[str, str], int]:
    """Named fields of the record at ``start`` and where its block begins; it ends at the first line that is no field."""
    at, head = data.find(LINE, start, start + LONGEST_VERSION) + 2, {}
    lines = 0
    if at < 2 or not data.startswith(b"WARC/1.", start):
        raise ValueError("no version line or header")
    while not data.startswith(LINE, at):
        end = data.find(LINE, at, at + LONGEST_LINE)
        name, sign, value = data[at:end].partition(b":") if end >= 0 else (b"", b"", b"")
        lines += 1
        if not sign or lines > MOST_FIELDS:
            raise ValueError("no version line or header" if end < 0 else "bad header")
        try:
            head[name.decode().lower()] = value.decode().strip()
        except UnicodeDecodeError:
            raise ValueError("bad header") from None
        at = end + 2
    return head, at + 2


def _parse(data: bytes, start: int = 0) -> tuple[dict, int]:
    """Fields of the record at ``start`` and where it ends; ValueError says which check failed."""
    head, begin = _header(data, start)
    if not head.get("content-length", "").isdecimal():
        raise ValueError("bad header")
    size, cut = int(head["content-length"]), begin - 4
    stop = cut + 4 + size
    if not data.startswith(END, stop):
        raise ValueError("length does not fit")
    block = data[cut + 4:stop]
    if head.get("warc-block-digest", "").removeprefix("sha256:") != hashlib.sha256(block).hexdigest():
        raise ValueError("digest does not fit")
    at = block.find(END)
    http, payload = block[:at].decode(errors="replace"), block[at + 4:]
    digest = head.get("warc-payload-digest", "").removeprefix("sha256:")
    if head.get("warc-type") == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("digest does not fit")
    try:
        number = lambda k: int(head[k]) if head.get(k) else None
        fields = {"page_id": number("x-page-id"), "url": head.get("warc-target-uri"), "record_type": head["warc-type"], "payload_digest": digest,
                  "payload_bytes": next(int(x.split(":")[1]) for x in http.split("\r\n") if x.lower().startswith("content-length:")),
                  "refers_to": number("x-refers-to-page-id"), "payload": payload if head["warc-type"] == "response" else None}
    except (ValueError, KeyError, StopIteration):
        raise ValueError("bad header") from None
    return fields, stop + 4


def _member(data: memoryview, at: int) -> tuple[bytes, int]:
    """Content of the gzip member at ``at`` and where it ends; zlib checks its CRC and length."""
    unpack, out, step, end = zlib.decompressobj(31), [], 8192, at
    while not unpack.eof:
        if end == len(data):
            raise ValueError("member breaks off")
        piece = data[end:end + step]  # few bytes at once: what is left over is copied
        out.append(unpack.decompress(piece))
        end += len(piece)
        if not unpack.eof and not any(out):
            raise ValueError("member without content")  # a name without end, say
        step = min(2 * step, 1 << 20)
    return b"".join(out), end - len(unpack.unused_data)


def records(data: bytes) -> Iterator[tuple[dict | None, int, int, str]]:
    """(fields, start, end, "") of each good record, (None, start, end, reason) of each quarantined gap, in file order."""
    at, gap, reason, marks = 0, None, "", Marks(data)

    def read(at: int) -> tuple[dict | None, int]:
        if data.startswith(MEMBER, at):
            try:
                content, end = _member(memoryview(data), at)
            except zlib.error:
                raise ValueError("member checksum or data") from None
            if not content:
                return None, end
            fields, size = _parse(content)
            if size != len(content):
                raise ValueError("member holds more than a record")
            return fields, end
        if data.startswith(b"WARC/1.", at):
            return _parse(data, at)
        raise ValueError("no member or version line")

    while at < len(data):
        try:
            fields, end = read(at)
        except ValueError as failed:
            if gap is None:
                gap, reason = at, str(failed)
            at = min(marks.next(MEMBER, at + 1), marks.next(b"WARC/1.", at + 1))
            continue
        if gap is not None:
            yield None, gap, at, reason
            gap = None
        if fields is not None:
            yield fields, at, end, ""
        at = end
    if gap is not None:
        yield None, gap, len(data), reason


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record and each quarantined gap (``reason`` set) of the archives in the folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    schema = ("file string, start long, end long, reason string, page_id long, url string, record_type string, payload_digest string, "
              "payload_bytes long, refers_to long, payload binary")
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            name, rows = b.column(0)[0].as_py(), []
            for fields, start, end, reason in records(b.column(1)[0].as_py()):
                rows.append({"file": name, "start": start, "end": end, "reason": reason or None} | (fields or {}))
                if len(rows) == 500:
                    yield pa.RecordBatch.from_pylist(rows, out)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, out)

    return files.mapInArrow(run, schema)


def op2_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write(spark.read.parquet(f"{sf}/pages.parquet"), path)
    found = read(spark, path).filter("reason is null")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
     f AS (SELECT page_id, n, sha256(h) AS d, CASE WHEN n >= {LEAST} THEN min(page_id) OVER (PARTITION BY h) END AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM f
"""

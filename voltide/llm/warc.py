"""WARC archives: writing with segmentation and revisits, reading back with
segment reassembly.

Writing: each page becomes an HTTP response in chunked transfer framing. A block
longer than a segment is spread over continuation records that name the origin
record. Of pages with equal payloads the one with the greatest id is written as
response, the others as revisits that refer to it. Spark's text writer writes the
files: a record is a row, and the blank lines that end a record are the line
separator.

Reading: each file is parsed by the content lengths of its records. Segments are
grouped by the identifier of their origin record, ordered by segment number,
checked for gaps and against the total length; then the chunked framing is
decoded and the payload digest is compared. Revisits take their payload's length
and digest from the record they refer to. Damaged archives raise.

Cases: a null html is an empty payload; a null or odd url is written escaped; of
repeated rows with the greatest id of their payload each is a response; a null
page id counts as the least and is read back as null; an empty table gives an
archive without records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.session import discard, materialize

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
RECORDS_PER_FILE = 50_000
END = b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked" + END


class DamagedArchive(ValueError):
    """An archive whose records do not fit together."""


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for k in range(0, len(payload), size) if (c := payload[k : k + size])]
    return b"".join(parts) + b"0" + END


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body (extensions and trailers are skipped)."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise DamagedArchive("chunk without a size line")
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise DamagedArchive("chunk is shorter than its size")
        out.append(body[at : at + size])
        at += size + 2


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def new_record_id() -> str:
    return f"<urn:uuid:{uuid.uuid4()}>"


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def _safe(url: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "urn:none")


def page_records(page_id: int | None, url: str | None, payload: bytes, origin: int | None, revisit: bool, segment: int) -> Iterator[bytes]:
    """The WARC records of one page."""
    own = new_record_id()
    common = [("WARC-Target-URI", _safe(url)), ("WARC-Date", "2020-01-01T00:00:00Z"), ("Content-Type", "application/http; msgtype=response")]
    digest = [("WARC-Payload-Digest", "sha1:" + payload_digest(payload))]
    first = [("WARC-Record-ID", own), ("Page-ID", page_id)]
    if revisit:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield _record([("WARC-Type", "revisit"), *first, *common, *digest, ("WARC-Profile", profile), ("Refers-To-Page-ID", origin)], HTTP)
        return
    block = HTTP + chunked(payload)
    pieces = [block[k : k + segment] for k in range(0, len(block), segment)]
    if len(pieces) == 1:
        yield _record([("WARC-Type", "response"), *first, *common, *digest], block)
        return
    yield _record([("WARC-Type", "response"), *first, *common, *digest, ("WARC-Segment-Number", 1)], pieces[0])
    for k, piece in enumerate(pieces[1:], 2):
        total = len(block) if k == len(pieces) else None
        links = [("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", total)]
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", new_record_id()), *common, *links], piece)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0, segment: int = SEGMENT_BYTES) -> None:
    """Writes gzipped WARC files under ``path``. Payloads of fewer than
    ``least`` bytes are never revisits."""
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    d = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    d = d.withColumns({"sha1": F.sha1("payload"), "n": F.octet_length("payload")})
    # Only hashes meet here, summed before the shuffle; the sums are written, so
    # that the join gets shuffles of its own and Spark can split a hot payload.
    classes = materialize(d.where(F.col("n") >= least).groupBy("sha1", "n").agg(F.max("page_id").alias("origin")), "payload-classes")
    d = d.join(classes, ["sha1", "n"], "left")
    d = d.select("page_id", "url", "payload", "origin", F.coalesce(F.col("origin") != F.coalesce("page_id", F.lit(-(1 << 63)).cast("long")), F.lit(False)).alias("revisit"))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += page_records(*row, segment)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    lines = d.mapInArrow(records, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    discard(classes)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record."""
    at = 0
    while at < len(data):
        stop = data.find(END, at)
        if stop < 0 or not data.startswith(b"WARC/", at):
            raise DamagedArchive("no record header")
        lines = data[at:stop].decode().split("\r\n")[1:]
        fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
        at = stop + len(END)
        size = int(fields["content-length"])
        block = data[at : at + size]
        if len(block) < size or data[at + size : at + size + len(END)] != END:
            raise DamagedArchive("record is shorter than its length")
        yield fields, block
        at += size + len(END)


def http_payload(block: bytes) -> bytes:
    """The decoded body of an HTTP response block."""
    head, end, body = block.partition(END)
    if not end:
        raise DamagedArchive("no HTTP header")
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


_PARTS = "page_id long, record_id string, type string, refers_to long, segment long, total long, digest string, payload binary"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _PARTS.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[x.split()[1]] for x in _PARTS.split(", ")]
    number = lambda f, k: int(f[k]) if k in f else None
    for batch in batches:
        for content in batch.column("content"):
            rows, held = [], 0
            for f, block in parse(zlib.decompress(content.as_buffer(), 47)):
                segment, kind = number(f, "warc-segment-number"), f["warc-type"]
                payload = block if segment else b"" if kind == "revisit" else http_payload(block)
                own = f.get("warc-segment-origin-id") or f["warc-record-id"]
                digest = f.get("warc-payload-digest", "").removeprefix("sha1:") or None
                total = number(f, "warc-segment-total-length")
                rows.append((number(f, "page-id"), own, kind, number(f, "refers-to-page-id"), segment, total, digest, payload))
                held += len(payload)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def reassemble(parts: list[dict]) -> bytes:
    """The payload of the segments of one record."""
    parts = sorted(parts, key=lambda p: p["segment"])
    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
        raise DamagedArchive("segments are missing or repeated")
    block = b"".join(p["payload"] for p in parts)
    if parts[-1]["total"] != len(block):
        raise DamagedArchive("segments do not add up to the total length")
    return http_payload(block)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            payload = pa.array([reassemble(row.column("parts")[0].as_py())], pa.binary())
            yield pa.RecordBatch.from_arrays([row.column("page_id"), row.column("record_id"), row.column("digest"), payload], ["page_id", "record_id", "digest", "payload"])


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, digest = [], []
        for want, payload in zip(batch.column("digest").to_pylist(), batch.column("payload"), strict=True):
            data = payload.as_buffer()
            digest.append(payload_digest(data))
            size.append(len(data))
            if want is not None and want != digest[-1]:
                raise DamagedArchive(f"payload digest is {digest[-1]}, not {want}")
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("record_id"), pa.array(size, pa.int64()), pa.array(digest), batch.column("payload")], ["page_id", "record_id", "payload_bytes", "payload_digest", "payload"])


def read_archive(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Responses (``page_id``, ``record_id``, ``payload_bytes``,
    ``payload_digest``, ``payload``) and revisits (``page_id``, ``refers_to``,
    ``payload_digest``) of all files under ``path``. Only
    segments are shuffled; a group is one record."""
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content").mapInArrow(_parts, _PARTS)
    revisits = parts.where("type = 'revisit'").select("page_id", "refers_to", F.col("digest").alias("payload_digest"))
    plain = parts.where("type = 'response' AND segment IS NULL").select("page_id", "record_id", "digest", "payload")
    segments = parts.where("segment IS NOT NULL").groupBy("record_id")
    segments = segments.agg(F.max("page_id").alias("page_id"), F.max("digest").alias("digest"), F.collect_list(F.struct("segment", "total", "payload")).alias("parts"))
    whole = segments.mapInArrow(_joined, "page_id long, record_id string, digest string, payload binary")
    responses = plain.unionByName(whole).mapInArrow(_measured, "page_id long, record_id string, payload_bytes long, payload_digest string, payload binary")
    return responses, revisits


def archive_index(spark: SparkSession, path: str) -> DataFrame:
    """Per page: ``page_id``, length and digest of its full payload, and whether
    it is a response or a revisit of which page. A revisit that refers to no record
    with its digest raises."""
    responses, revisits = read_archive(spark, path)
    responses = responses.select("page_id", "payload_bytes", "payload_digest")
    origin = responses.groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("found"))
    seen = revisits.join(origin, ["refers_to", "payload_digest"], "left")
    size = F.coalesce("found", F.raise_error(F.lit("a revisit refers to no record with its payload")).cast("long"))
    seen = seen.select("page_id", size.alias("payload_bytes"), "payload_digest", F.lit("revisit").alias("record_type"), "refers_to")
    return responses.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).union(seen)

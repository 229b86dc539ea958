"""WARC archives: writing with revisits, segments and chunked framing, and reading by segment reassembly.

Writing: each payload becomes the body of an HTTP response in chunked transfer framing. A record whose
block is longer than ``segment_bytes`` is cut into a first segment and continuation records. Records are
packed into rows of some MiB which Spark's text writer puts end to end, through its commit protocol, into
files of bounded size in the shared folder; no task writes files of its own.

Reading: files are parsed by content length. Segments are grouped by the identifier of their origin, put
in order by their numbers, and held against the total length that the last one states; then the chunked
framing is decoded and the digest verified.

Revisits name the response that they refer to by its page's id, in a field of its own, and for other readers by its
address and date, if it has an address. Ids are spelled with all but letters, digits and ``_.-~`` percent-encoded.

Defined results: a null payload is empty; a null id is kept as null; ids may be of any type that a text can be cast
back to; rows that are repeated with the id
of the chosen response are responses too; a malformed stretch of an archive is skipped to the next record;
a record with a missing segment, wrong total length, broken framing or wrong digest is returned with its
``error`` and no payload; an empty table gives no records. Columns that are not named are not written.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import private, shared_path

REVISIT_MIN_BYTES = 1000
SEGMENT_BYTES = 1 << 20
CHUNK_BYTES = 1 << 14
#: Bytes of records that are packed into one row, and rows in a file: together they bound a file.
PACK_BYTES = 1 << 22
PACKS_PER_FILE = 8
DATE = "2024-01-01T00:00:00Z"

_START = re.compile(rb"WARC/1\.[01]\r\n")


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a body."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The body within chunked transfer framing; extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size is cut off")
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if not size:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut off")
        parts.append(body[at : at + size])
        at += size + 2


def _record(kind: str, fields: dict[str, object], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields.items() if v is not None), f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _line(value: str | None) -> str | None:
    """A header's value: no line ends or other control characters."""
    return None if value is None else "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def _spelled(page_id: object) -> str | None:
    return None if page_id is None else quote(str(page_id), safe="")


def records_of(page_id: object, url: str | None, payload: bytes | None, digest: str, refers_to: object, there: str | None, serial: int, segment_bytes: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The WARC records of one page. ``refers_to`` and ``there``: id and address of the page that it revisits."""
    own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{serial}')}>"
    fields = {"WARC-Record-ID": own, "WARC-Date": DATE, "WARC-Target-URI": _line(url), "WARC-Payload-Digest": f"sha1:{digest}", "Page-Id": _spelled(page_id)}
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield _record("revisit", fields | {"WARC-Profile": profile, "WARC-Refers-To-Target-URI": _line(there), "WARC-Refers-To-Date": DATE if there is not None else None, "Refers-To-Page-Id": _spelled(refers_to), "Content-Type": "application/http;msgtype=response"}, b"HTTP/1.1 200 OK\r\n\r\n")
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload or b"")
    fields["Content-Type"] = "application/http;msgtype=response"
    parts = range(0, len(block), segment_bytes)
    if len(parts) == 1:
        yield _record("response", fields, block)
        return
    for n, at in enumerate(parts, 1):
        total = len(block) if n == len(parts) else None
        part = block[at : at + segment_bytes]
        if n == 1:
            yield _record("response", fields | {"WARC-Segment-Number": 1}, part)
        else:
            part_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{own}/{n}')}>"
            yield _record("continuation", {"WARC-Record-ID": part_id, "WARC-Date": DATE, "WARC-Segment-Origin-ID": own, "WARC-Segment-Number": n, "WARC-Segment-Total-Length": total}, part)


def write(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", revisit_min: int = REVISIT_MIN_BYTES, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write one record for each page to archives below ``path``.

    The choice of responses is a grouped maximum by digest, combined map-side. Its join back is one
    with at most one row a digest on the other side, whose hot digests adaptive execution splits.
    """
    source = private(pages, id=id_col, url=url_col, payload=payload_col)
    source = source.select(F.col("id").alias("own"), F.col("id").cast("string").alias("id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload"))
    source = source.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= revisit_min
    named = F.when(F.col("id").isNotNull(), F.struct("own", "id", "url"))
    first = source.where(large).groupBy("digest").agg(F.max(named).alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n")
    source = source.join(first, "digest", "left")
    again = F.col("first").isNotNull() & large & ~F.col("first.id").eqNullSafe(F.col("id"))
    source = source.select("id", "url", F.when(~again, F.col("payload")).alias("payload"), "digest", F.when(again, F.col("first.id")).alias("refers_to"), F.when(again, F.col("first.url")).alias("there"), F.monotonically_increasing_id().alias("serial"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, held = [], 0
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(7))):
                for record in records_of(*(x.as_py() for x in row), segment_bytes=segment_bytes):
                    pack.append(record)
                    held += len(record)
                    if held >= PACK_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array([b"".join(pack)[:-1]], pa.binary())], names=["value"])
                        pack, held = [], 0
        if pack:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(pack)[:-1]], pa.binary())], names=["value"])

    # the writer ends each row with the line feed that was cut off its last record
    packs = source.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    packs.write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", PACKS_PER_FILE).text(path)


def _plain(content: bytes) -> bytes:
    """Archives may be plain, or gzip of one or many members."""
    parts = []
    while content[:2] == b"\x1f\x8b":
        inflate = zlib.decompressobj(31)
        parts += [inflate.decompress(content), inflate.flush()]
        content = inflate.unused_data
    return b"".join(parts) if parts else content


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields (names in lower case) and block of each record; what can't be parsed is skipped."""
    content, at = _plain(content), 0
    while found := _START.search(content, at):
        head = content.find(b"\r\n\r\n", found.end() - 2)
        if head < 0:
            return
        lines = content[found.end() : head].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = fields.get("content-length", "")
        if not length.isdigit() or head + 4 + int(length) > len(content):
            at = found.end()
            continue
        at = head + 4 + int(length)
        yield fields, content[head + 4 : at]


def decode(block: bytes) -> bytes:
    """The payload of an HTTP response."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("no end of the HTTP header")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:[^\r\n]*\bchunked\b", head) else body


_RECORD = T.StructType(
    [T.StructField(n, t) for n, t in (("record_id", T.StringType()), ("record_type", T.StringType()), ("page_id", T.StringType()), ("url", T.StringType()), ("refers_to", T.StringType()), ("digest", T.StringType()), ("payload", T.BinaryType()), ("error", T.StringType()))]
)
_SEGMENT = T.StructType([T.StructField("number", T.IntegerType()), T.StructField("total", T.LongType()), T.StructField("block", T.BinaryType())])
_PARSED = T.StructType([*_RECORD.fields, T.StructField("origin", T.StringType()), T.StructField("segment", _SEGMENT)])


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and re.fullmatch(r"-?\d+", text) else None


def _named(text: str | None) -> str | None:
    return None if text is None else unquote(text)


def _payload(block: bytes, digest: str | None) -> tuple[bytes | None, str | None]:
    try:
        payload = decode(block)
    except ValueError as e:
        return None, str(e)
    if digest and hashlib.sha1(payload).hexdigest() != digest:
        return None, "digest differs"
    return payload, None


def read(spark: SparkSession, path: str) -> DataFrame:
    """``record_id, record_type, page_id, url, refers_to, digest, payload, error`` of each response and revisit, ids as texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.string()), ("url", pa.string()), ("refers_to", pa.string()), ("digest", pa.string()), ("payload", pa.binary()), ("error", pa.string()), ("origin", pa.string()), ("segment", pa.struct([("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary())]))])
        rows, held = [], 0
        for batch in batches:
            for content in batch.column(0):
                for fields, block in parse(content.as_py()):
                    kind, own, number = fields.get("warc-type"), fields.get("warc-record-id"), _number(fields.get("warc-segment-number"))
                    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:").lower() or None
                    row = {"record_id": own, "record_type": kind, "page_id": _named(fields.get("page-id")), "url": fields.get("warc-target-uri"), "refers_to": _named(fields.get("refers-to-page-id")), "digest": digest}
                    if kind not in ("response", "revisit", "continuation"):
                        continue
                    if number is not None:
                        row |= {"origin": own if number == 1 else fields.get("warc-segment-origin-id"), "segment": {"number": number, "total": _number(fields.get("warc-segment-total-length")), "block": block}}
                    elif kind == "response":
                        row["payload"], row["error"] = _payload(block, digest)
                    rows.append(row)
                    held += len(block)
                    if held >= PACK_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.string()), ("url", pa.string()), ("refers_to", pa.string()), ("digest", pa.string()), ("payload", pa.binary()), ("error", pa.string())])
        for batch in batches:
            for first, segments in zip(batch.column(0), batch.column(1)):
                row, parts = first.as_py() or {}, sorted(segments.as_py(), key=lambda s: s["number"])
                block = b"".join(s["block"] for s in parts)
                if [s["number"] for s in parts] != list(range(1, len(parts) + 1)):
                    row["error"] = "a segment is missing or repeated"
                elif parts[-1]["total"] != len(block):
                    row["error"] = "total length differs"
                else:
                    row["payload"], row["error"] = _payload(block, row.get("digest"))
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    parsed = files.mapInArrow(run, _PARSED)
    whole = parsed.where("segment is null and record_type <> 'continuation'").select(*_RECORD.names)
    head = F.struct(*_RECORD.names)
    # a group is the segments of one record
    cut = parsed.where("segment is not null").groupBy("origin").agg(F.first(F.when(F.col("segment.number") == 1, head), ignorenulls=True).alias("head"), F.collect_list("segment").alias("segments"))
    return whole.union(cut.select("head", "segments").mapInArrow(join, _RECORD))


def round_trip(pages: DataFrame, **names: str) -> DataFrame:
    """Write archives into the shared folder and read them back: a row for each page, payload facts of the full payload.

    A revisit has the payload of the response that it names: its length comes from there.
    """
    spark = pages.sparkSession
    kind = private(pages, id=names.get("id_col", "page_id")).schema["id"].dataType
    path = shared_path(spark, "archives")
    write(pages, path, **names)
    records = read(spark, path).select("page_id", "url", "record_type", "refers_to", "digest", "error", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    there = records.where("record_type = 'response' and error is null").groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("digest")).agg(F.max("payload_bytes").alias("there_bytes"))
    joined = records.join(there, ["refers_to", "digest"], "left")
    revisit = F.col("record_type") == "revisit"
    return joined.select(F.col("page_id").cast(kind).alias("page_id"), F.when(revisit, F.col("there_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"), F.when(revisit, F.col("digest")).otherwise(F.col("payload_digest")).alias("payload_digest"), "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "url", "error")

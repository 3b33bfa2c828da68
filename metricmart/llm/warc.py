"""WARC archives: write pages as records, read them back, put segmented records together again.

A response record holds an HTTP message whose body is sent in chunks. A block longer than ``segment_bytes`` is split:
the first segment is the response itself, the others are continuation records that name it as their origin. Reading
groups segments by origin, orders them by number, verifies the total length, and undoes the chunked framing.
Pages whose payload was written before become revisit records without a payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricmart.llm.common import col

CRLF = b"\r\n"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = 4096) -> bytes:
    """Chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(payload[i : i + size]), payload[i : i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(message: bytes) -> bytes | None:
    """The body of an HTTP message, its chunked framing undone where the head declares it; None if it is broken."""
    head, gap, rest = message.partition(CRLF + CRLF)
    if not gap:
        return None
    if not re.search(rb"\r\ntransfer-encoding:[^\r]*chunked", head, re.I):
        return rest
    at, parts = 0, []
    while True:
        end = rest.find(CRLF, at)
        if end < 0:
            return None
        try:
            size = int(rest[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        if size == 0:
            return b"".join(parts)
        data = rest[end + 2 : end + 2 + size]
        if len(data) < size or rest[end + 2 + size : end + 4 + size] != CRLF:
            return None
        parts.append(data)
        at = end + 4 + size


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record without its closing line breaks. Field values lose line breaks, so that none can forge a field."""
    head = [VERSION]
    for name, value in [*fields, ("Content-Length", str(len(block)))]:
        if value is not None:
            head.append(f"{name}: {re.sub('[\r\n]+', ' ', value)}".encode())
    return CRLF.join(head) + CRLF + CRLF + block


def page_records(
    key: str, page: str | None, url: str | None, kind: str, payload: bytes, refers: str | None, date: str, segment_bytes: int
) -> list[bytes]:
    """The records of one page: a revisit, or a response and its continuations."""
    common = [("WARC-Target-URI", url), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"), ("X-Page-Id", page)]
    identity = ("WARC-Record-ID", f"<urn:uuid:{key}>")
    http = ("Content-Type", "application/http; msgtype=response")
    if kind == "revisit":
        extra = [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:uuid:{refers}>")]
        return [_record([("WARC-Type", "revisit"), identity, *common, *extra, http], HTTP_HEAD)]
    block = HTTP_HEAD + chunked(payload)
    pieces = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    number = ("WARC-Segment-Number", "1" if len(pieces) > 1 else None)
    records = [_record([("WARC-Type", "response"), identity, *common, number, http], pieces[0])]
    for n, piece in enumerate(pieces[1:], 2):
        own = f"<urn:uuid:{uuid.uuid5(uuid.UUID(key), str(n))}>"
        total = str(len(block)) if n == len(pieces) else None
        records.append(_record([
            ("WARC-Type", "continuation"), ("WARC-Record-ID", own), ("WARC-Date", date), ("WARC-Segment-Origin-ID", f"<urn:uuid:{key}>"),
            ("WARC-Segment-Number", str(n)), ("WARC-Segment-Total-Length", total),
        ], piece))
    return records


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields in lower case, block) of every record of a file, by content length."""
    at = data.find(VERSION)
    while at >= 0:
        end = data.find(CRLF + CRLF, at)
        if end < 0:
            return
        fields = {}
        for line in data[at:end].split(CRLF)[1:]:
            name, _, value = line.decode(errors="replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields.get("content-length", 0))
        yield fields, data[end + 4 : end + 4 + size]
        at = data.find(VERSION, end + 4 + size)


def _planned(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """Pages with their record type; of equal payloads the smallest page id is the response."""
    rows = pages.select(
        col(id_col).alias("page"), col(url_col).cast("string").alias("url"), F.coalesce(col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    )
    rows = rows.withColumn("same", F.sha2("payload", 256))
    each = rows.filter(F.octet_length("payload") >= min_bytes).groupBy("same", "page").agg(F.count(F.lit(1)).alias("copies"))
    groups = each.groupBy("same").agg(F.min(F.struct(F.col("page").isNull().alias("missing"), "page", "copies")).alias("first"), F.sum("copies").alias("rows"))
    shared = groups.filter("rows > 1").select(F.col("same").alias("of"), F.col("first.page").alias("original"), F.col("first.copies").alias("copies"))
    joined = rows.join(shared, F.col("same") == F.col("of"), "left")
    leads = F.col("of").isNull() | F.col("page").eqNullSafe(F.col("original"))
    columns = ["page", "url", "payload", "same", "original"]
    planned = joined.select(*columns, "copies", F.when(leads, "response").otherwise("revisit").alias("type"))
    single = planned.filter("type = 'revisit' OR copies IS NULL OR copies = 1")
    if shared.filter("copies > 1").isEmpty():
        return single
    again = planned.filter("type = 'response' AND copies > 1").withColumn("row", F.row_number().over(Window.partitionBy("same", "page").orderBy("url")))
    return single.unionByName(again.withColumn("type", F.when(F.col("row") == 1, "response").otherwise("revisit")).drop("row"))


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0,
    segment_bytes: int = 16384, file_records: int = 4096, date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write one WARC record per page (and continuations) to gzip files in ``path``.

    Payloads are UTF-8; null is empty. Of equal payloads of at least ``min_bytes`` the page with the smallest id is a
    response, the others revisit it (a null id comes last; of rows that repeat an id and payload the first by url
    leads). Smaller payloads are all responses. An empty table writes an archive without records. Files hold at most
    ``file_records`` records of at most ``segment_bytes``, so that a reader can hold one.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                key, page, url, kind, payload, refers = row
                refers = str(uuid.UUID(hex=refers)) if refers else None
                records = page_records(str(uuid.UUID(hex=key)), page, url, kind, payload, refers, date, segment_bytes)
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["value"])

    planned = _planned(pages, id_col, url_col, payload_col, min_bytes)
    name = lambda page: F.md5(F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("none")), "same"))
    own = F.when(F.col("type") == "response", name(F.col("page"))).otherwise(
        F.md5(F.concat_ws("|", F.lit("revisit"), F.coalesce(F.col("page").cast("string"), F.lit("none")), F.monotonically_increasing_id().cast("string")))
    )
    records = planned.select(
        own.alias("key"), F.col("page").cast("string").alias("page"), "url", "type", "payload",
        F.when(F.col("type") == "revisit", name(F.col("original"))).alias("refers"),
    ).mapInArrow(build, "value binary")
    (
        records.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n")
        .option("compression", "gzip").option("maxRecordsPerFile", file_records).text(path)
    )


def read_archive(spark: SparkSession, path: str, scratch, id_type: str = "long", with_payload: bool = True) -> DataFrame:
    """Every page of the archives in ``path``, revisits included.

    Returns ``page_id``, ``record_type``, ``refers_to`` (page id, of revisits), ``payload_bytes`` and ``payload_digest``
    (of a revisit: of the response it refers to), ``intact`` (all segments are there, the total length and the declared
    digest are right) and, if asked for, ``payload``. What cannot be put together has a null payload and is not intact.
    """
    fields = "record string, page string, type string, declared string, refers string, origin string, segment int, total long"
    done = "payload_bytes long, payload_digest string, payload binary"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                some, held = [], 0
                for head, block in parse_records(gzip.decompress(content.as_py())):
                    part = "warc-segment-number" in head
                    body = unchunked(block) if head.get("warc-type") == "response" and not part else None
                    some.append((
                        head.get("warc-record-id"), head.get("x-page-id"), head.get("warc-type"),
                        head.get("warc-payload-digest", "").removeprefix("sha1:") or None, head.get("warc-refers-to"),
                        head.get("warc-segment-origin-id"), int(head["warc-segment-number"]) if part else None,
                        int(head["warc-segment-total-length"]) if "warc-segment-total-length" in head else None,
                        None if body is None else len(body), None if body is None else payload_digest(body),
                        body if with_payload else None, block if part else None,
                    ))
                    held += len(block)
                    if held > 4 << 20:
                        yield batch_of(some)
                        some, held = [], 0
                if some:
                    yield batch_of(some)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string()] * 6 + [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
        names = ["record", "page", "type", "declared", "refers", "origin", "segment", "total", "payload_bytes", "payload_digest", "payload", "block"]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    parsed = scratch.store(files.mapInArrow(parse, f"{fields}, {done}, block binary"), "parsed")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts, total in zip(batch.column("parts").to_pylist(), batch.column("total").to_pylist()):
                message = b"".join(p["block"] for p in parts)
                whole = [p["segment"] for p in parts] == list(range(1, len(parts) + 1)) and total == len(message)
                body = unchunked(message) if whole else None
                out.append((None, None, None) if body is None else (len(body), payload_digest(body), body if with_payload else None))
            values = [pa.array([r[i] for r in out], k) for i, k in enumerate((pa.int64(), pa.string(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column("record"), batch.column("page"), batch.column("declared"), *values],
                                             names=["record", "page", "declared", "payload_bytes", "payload_digest", "payload"])

    own = lambda c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
    joined = (
        parsed.filter("segment IS NOT NULL").withColumn("of", F.coalesce("origin", "record")).groupBy("of")
        .agg(F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"), F.max("total").alias("total"), own("record"), own("page"), own("declared"))
        .select("record", "page", "declared", "parts", "total")
        .mapInArrow(assemble, f"record string, page string, declared string, {done}")
    )
    whole = parsed.filter("type = 'response' AND segment IS NULL").select("record", "page", "declared", "payload_bytes", "payload_digest", "payload")
    responses = whole.unionByName(joined)
    page = F.col("page").cast(id_type)
    intact = F.coalesce(F.col("payload_digest") == F.col("declared"), F.lit(False)).alias("intact")
    first = responses.select(
        page.alias("page_id"), F.lit("response").alias("record_type"), F.lit(None).cast(id_type).alias("refers_to"),
        "payload_bytes", "payload_digest", "payload", intact,
    )
    known = responses.select(F.col("record").alias("of"), F.col("page").cast(id_type).alias("refers_to"), "payload_bytes", "payload_digest", "payload")
    others = parsed.filter("type = 'revisit'").select("page", "refers", "declared").join(known, F.col("refers") == F.col("of"), "left").select(
        page.alias("page_id"), F.lit("revisit").alias("record_type"), "refers_to", "payload_bytes", "payload_digest", "payload", intact,
    )
    out = first.unionByName(others)
    return out if with_payload else out.drop("payload")

"""Web archives in segments: written from pages, read back by reassembly.

A response block (HTTP header and body in chunked transfer framing) longer than ``SEGMENT`` is
split into a first record and continuation records. Reading groups continuations by the id of
their origin, orders them by segment number, verifies numbers and total length, and decodes the
framing. Whole records are decoded where they are read; only segments are shuffled. Pages with the
payload of another become revisit records, which take length and digest from the record they name.

Archives are plain gzip files of bounded size in a folder that Spark writes and reads.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import landed, small_batches

#: Bytes of a record's block; longer blocks are continued.
SEGMENT = 4096
#: Bytes of a chunk of the body.
CHUNK = 1500
#: Bytes of an archive before compression.
ARCHIVE = 8 << 20
#: Payloads from this size on are written once.
LEAST_REPEATED = 1000
#: Repeated payloads (40 bytes each) up to which they are broadcast; joined otherwise.
BROADCAST_ROWS = 500_000
DATE = "2025-01-01T00:00:00Z"
END = b"\r\n\r\n"


def _record_id(*parts: object) -> str:
    digest = hashlib.sha256(repr(parts).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=digest[:16])}>"


def _record(kind: str, record_id: str, block: bytes, **headers: object) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE)]
    lines += [(n.replace("_", "-"), v) for n, v in headers.items() if v is not None]
    head = "".join(f"{n}: {v}\r\n" for n, v in [*lines, ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """Body in chunked transfer framing."""
    parts = [payload[a : a + size] for a in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Content of a chunked body, trailers ignored; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size is missing")
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        part = body[end + 2 : end + 2 + size]
        if len(part) < size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("chunk is cut")
        out.append(part)
        at = end + 4 + size


def payload_of(block: bytes) -> bytes:
    """Body of an HTTP response, its framing removed."""
    head, found, body = block.partition(END)
    if not found:
        raise ValueError("HTTP header does not end")
    if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head.replace(b"\r", b"")):
        return unchunked(body)
    return body


def page_records(page_id: int | None, url: str | None, payload: bytes, keeper: int | None, repeated: bool, segment: int) -> Iterator[bytes]:
    """The records of one page, each without the blank lines after it."""
    digest = hashlib.sha1(payload).digest()
    known = {
        "WARC_Target_URI": None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%-._~"),
        "WARC_Payload_Digest": "sha1:" + base64.b32encode(digest).decode(),
        "X_Page_ID": page_id,
    }
    if repeated and page_id != keeper:
        head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
        refers = _record_id("response", keeper, digest)
        yield _record("revisit", _record_id("revisit", page_id, digest), head, **known, WARC_Refers_To=refers, Content_Type="application/http;msgtype=response")
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    own, total = _record_id("response", page_id, digest), len(block)
    parts = [block[a : a + segment] for a in range(0, total, segment)]
    more = {"WARC_Segment_Number": 1} if len(parts) > 1 else {}
    yield _record("response", own, parts[0], **known, **more, Content_Type="application/http;msgtype=response")
    for number, part in enumerate(parts[1:], 2):
        last = total if number == len(parts) else None
        yield _record(
            "continuation", _record_id(own, number), part,
            WARC_Segment_Origin_ID=own, WARC_Segment_Number=number, WARC_Segment_Total_Length=last,
        )


def _write(segment: int, archive: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([END.join(held)], pa.binary())], names=["value"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page_id, url, html, keeper, repeated = row
                for record in page_records(page_id, url, html, keeper, bool(repeated), segment):
                    held.append(record)
                    size += len(record)
                if size >= archive:
                    yield closed()
                    held, size = [], 0
        if held:
            yield closed()

    return write


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT, archive: int = ARCHIVE) -> None:
    """Archives of ``pages`` (page_id, url, html) below ``path``.

    A null html is an empty payload. Of equal payloads of ``LEAST_REPEATED`` bytes or more the one
    with the largest page_id is written, by each row that has that id; the others revisit it.
    """
    small_batches(pages.sparkSession)
    html = F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    equal = rows.filter(F.octet_length("html") >= LEAST_REPEATED).groupBy("digest")
    repeated = equal.agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = landed(repeated.select("digest", "keeper", F.lit(True).alias("repeated")), "repeated")
    few = repeated.count() <= BROADCAST_ROWS
    marked = rows.join(F.broadcast(repeated) if few else repeated, "digest", "left")
    archives = marked.select("page_id", "url", "html", "keeper", "repeated").mapInArrow(_write(segment, archive), "value binary")
    # One row is one archive is one file; the line separator is what ends its last record.
    archives.select(F.col("value").cast("string")).write.options(
        lineSep=END.decode(), maxRecordsPerFile=1, compression="gzip"
    ).text(path)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of an archive's records."""
    at = 0
    while at < len(data):
        end = data.index(END, at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines)}
        start = end + 4
        end = start + int(headers["content-length"])
        if end > len(data):
            raise ValueError("record is cut")
        yield headers, data[start:end]
        at = end + 4


#: What is known of a page's record; problem is null unless its payload could not be restored.
PAGE = "record_id string, page_id long, url string, record_type string, refers_id string, payload_bytes long, payload_digest string, problem string"
SEGMENTS = "origin string, segment int, total long, page_id long, url string, digest string, block binary"


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def _restored(block: bytes, digest: str | None) -> tuple[bytes | None, str | None]:
    """(payload, problem) of a whole block."""
    try:
        payload = payload_of(block)
    except ValueError as error:
        return None, str(error)
    own = hashlib.sha1(payload).digest()
    if digest and digest.removeprefix("sha1:") != base64.b32encode(own).decode():
        return None, "digest differs"
    return payload, None


def _page(record_id, page_id, url, kind, refers, payload, problem, keep: bool) -> tuple:
    sizes = (None, None) if payload is None else (len(payload), hashlib.sha1(payload).hexdigest())
    return (record_id, page_id, url, kind, refers, *sizes, problem) + ((payload,) if keep else ())


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (field.split() for field in ddl.split(", "))])


def _read(segments: bool, keep: bool):
    """Reads archives to their segments, or to their whole records."""
    schema = _arrow(SEGMENTS if segments else PAGE + ", payload binary" * keep)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for h, block in records(zlib.decompressobj(31).decompress(content.as_py())):
                    part, kind = h.get("warc-segment-number"), h["warc-type"]
                    page = (_number(h.get("x-page-id")), h.get("warc-target-uri"))
                    if segments and part:
                        origin = h.get("warc-segment-origin-id", h["warc-record-id"])
                        rows.append((origin, int(part), _number(h.get("warc-segment-total-length")), *page, h.get("warc-payload-digest"), block))
                    elif not segments and not part:
                        payload, problem = (None, None) if kind == "revisit" else _restored(block, h.get("warc-payload-digest"))
                        rows.append(_page(h["warc-record-id"], *page, kind, h.get("warc-refers-to"), payload, problem, keep))
                yield _batch(rows, schema)

    return read


def joined_segments(parts: list[dict]) -> Iterator[tuple[bytes | None, str | None]]:
    """(block, problem) for every copy of a record, from its segments in any order."""
    by_number = defaultdict(list)
    for part in parts:
        by_number[part["segment"]].append(part)
    numbers = sorted(by_number)
    copies = max(len(p) for p in by_number.values())
    totals = {p["total"] for p in by_number[numbers[-1]]}
    total = next(iter(totals))
    block = b"".join(by_number[n][0]["block"] for n in numbers)
    problem = None
    if numbers != list(range(1, len(numbers) + 1)) or total is None:
        problem = "segment is missing"
    elif any(len(p) < copies or len({x["block"] for x in p}) > 1 for p in by_number.values()) or len(totals) > 1:
        problem = "copies of segments differ"
    elif len(block) != total:
        problem = f"length is {len(block)} of {total}"
    for _ in range(copies):
        yield (None, problem) if problem else (block, None)


def _join_segments(keep: bool):
    schema = _arrow(PAGE + ", payload binary" * keep)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = []
                for row in batch.slice(at, 200).to_pylist():
                    for block, problem in joined_segments(row["parts"]):
                        payload = None
                        if block is not None:
                            payload, problem = _restored(block, row["digest"])
                        rows.append(_page(row["origin"], row["page_id"], row["url"], "response", None, payload, problem, keep))
                yield _batch(rows, schema)

    return join


def read_archives(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest (hex SHA-1), record_type, refers_to and problem
    of every page's record below ``path``; with ``keep_payload`` also the payload of responses.

    A record that can't be restored has nulls and says why. Revisits of unknown records, too.
    """
    schema = PAGE + ", payload binary" * keep_payload
    archives = spark.read.format("binaryFile").load(path).select("content")
    whole = archives.mapInArrow(_read(False, keep_payload), schema)
    parts = archives.mapInArrow(_read(True, keep_payload), SEGMENTS).groupBy("origin").agg(
        F.max("page_id").alias("page_id"),
        F.max("url").alias("url"),
        F.max("digest").alias("digest"),
        F.collect_list(F.struct("segment", "total", "block")).alias("parts"),
    )
    pages = landed(whole.unionByName(parts.mapInArrow(_join_segments(keep_payload), schema)), "pages")
    payload = ["payload"] if keep_payload else []
    common = ["page_id", "url", "payload_bytes", "payload_digest", "record_type"]
    revisits, responses = pages.filter("record_type = 'revisit'"), pages.filter("record_type <> 'revisit'")
    origin = responses.groupBy(F.col("record_id").alias("refers_id")).agg(
        F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("bytes"), F.max("payload_digest").alias("digest")
    )
    resolved = revisits.select("page_id", "url", "record_type", "refers_id", *payload).join(origin, "refers_id", "left")
    missing = F.when(F.col("digest").isNull(), F.lit("revisited record is missing"))
    return responses.select(*common, F.lit(None).cast("long").alias("refers_to"), "problem", *payload).unionByName(
        resolved.select(
            "page_id", "url", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
            "record_type", "refers_to", missing.alias("problem"), *payload,
        )
    )

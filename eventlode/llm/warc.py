"""Web archives: writing WARC records and reading them back, with segmented records and chunked bodies.

A response's HTTP message is framed in chunks and cut into segments: the first record carries the headers, the others
are continuation records that name it as their origin. Reading groups continuations by origin, orders them by segment
number, checks the total length, and undoes the chunk framing. Payloads that occur again are written as revisit records.
Every record is a gzip member of its own, so that one can be read without what lies before it.
Archives are written and read through Spark's file sources, so any store that Spark reaches will do.
"""

from __future__ import annotations

import datetime
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlode.session import materialize, work_dir

from .common import batches, byte_texts, map_arrow, table

CRLF = "\r\n"
# Bytes in a chunk and in a segment, at most.
CHUNK, SEGMENT = 8_192, 65_536
# Records in a file; with the segment size this bounds what reading one file takes.
RECORDS_PER_FILE = 1_000
# Payload bytes after which a task hands its records on.
BATCH_BYTES = 8 << 20
# Compression level of records.
LEVEL = 6
# Payloads smaller than this are always stored.
LEAST_REVISIT = 100

HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
# Fixed value: the profile of revisits whose payload is known by its digest.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REVISIT_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _cuts(data: bytes, size: int) -> Iterator[bytes]:
    """UTF-8 text in pieces of at most ``size`` bytes, never cutting a character."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


def chunked(payload: bytes) -> bytes:
    """The payload in HTTP chunk framing."""
    frames = [b"%x\r\n%b\r\n" % (len(x), x) for x in _cuts(payload, CHUNK)]
    return b"".join((*frames, b"0\r\n\r\n"))


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One WARC record without its last line break. Headers that are None are left out; line breaks in them become spaces."""
    lines = [f"{k}: {' '.join(str(v).splitlines())}" for k, v in headers if v is not None]
    return CRLF.join(("WARC/1.1", *lines, f"Content-Length: {len(block)}", "", "")).encode() + block + b"\r\n"


def with_revisits(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, payload) with row, payload_digest, payload_bytes, ``first`` and ``first_row``.

    ``first`` is the smallest page_id with the same payload, or null if the payload is small or occurs once; ``first_row``
    tells which of its rows. They are aggregated per digest before they are joined back, so a payload shared by very many
    pages is one row. Rows are numbered by where they are stored, so ``pages`` must come from a scan.
    """
    keyed = pages.withColumns({"row": F.monotonically_increasing_id(), "payload_digest": F.sha2("payload", 256),
                               "payload_bytes": F.octet_length("payload").cast("long")})
    least = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "row")))
    firsts = (keyed.where(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("payload_digest")
              .agg(least.alias("least"), F.count("*").alias("n")).where("n > 1")
              .select("payload_digest", F.col("least.page_id").alias("first"), F.col("least.row").alias("first_row")))
    return keyed.join(firsts, "payload_digest", "left")


def page_records(page_id: int | None, row: int, url: str | None, payload: bytes, digest: str, first: int | None,
                 first_row: int | None, date: str) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response and its continuations."""
    revisit = first is not None and page_id != first
    # The number after # tells repeated rows of a page apart.
    urn = f"urn:page:{'null' if page_id is None else page_id}#{row}"
    block = REVISIT_HEAD if revisit else HTTP_HEAD + chunked(payload)
    parts = list(_cuts(block, SEGMENT))
    for k, part in enumerate(parts, 1):
        own = [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}"),
               ("WARC-Refers-To", f"<urn:page:{first}#{first_row}>" if revisit else None),
               ("WARC-Profile", REVISIT_PROFILE if revisit else None)]
        yield record([
            ("WARC-Type", "continuation" if k > 1 else "revisit" if revisit else "response"),
            ("WARC-Record-ID", f"<{urn}>" if k == 1 else f"<{urn}.{k}>"), ("WARC-Date", date), ("WARC-Target-URI", url),
            *(own if k == 1 else [("WARC-Segment-Origin-ID", f"<{urn}>")]),
            ("WARC-Segment-Number", k if len(parts) > 1 else None),
            ("WARC-Segment-Total-Length", len(block) if k == len(parts) > 1 else None),
        ], part)


def member(data: bytes) -> bytes:
    """The data as one gzip member that ends in a zero byte.

    A member ends in its data's length, lowest byte first, so data of less than 16 MB end in a zero. Longer ones get an
    empty member besides, which readers pass over.
    """
    packed = gzip.compress(data, LEVEL, mtime=0)
    return packed if packed[-1] == 0 else packed + gzip.compress(b"", LEVEL, mtime=0)


def warc_records(pages: DataFrame) -> DataFrame:
    """WARC records as gzip members (column ``value``, without their last byte), from the rows of ``with_revisits``."""
    date = datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in items:
            payloads = byte_texts(batch.column("payload"))
            others = [batch.column(c).to_pylist() for c in ("page_id", "row", "url", "payload_digest", "first", "first_row")]
            lines, size = [], 0
            for page_id, row, url, digest, first, first_row, payload in zip(*others, payloads, strict=True):
                lines += [member(x + b"\r\n")[:-1] for x in page_records(page_id, row, url, payload, digest, first, first_row, date)]
                size += len(payload)
                if size > BATCH_BYTES:
                    yield batches({"value": pa.array(lines, pa.binary())})
                    lines, size = [], 0
            if lines:
                yield batches({"value": pa.array(lines, pa.binary())})

    return map_arrow(pages, run, "value binary")


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one record per row, continuations besides. Null html is an empty payload; a null url has no header."""
    given = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("payload"))
    # The text writer copies bytes as they are and ends every row with the separator: the zero each member ends in.
    (warc_records(with_revisits(given)).select(F.col("value").cast("string")).write.option("lineSep", "\0").option("compression", "none")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode("utf-8").split(CRLF)
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
        start = end + 4
        stop = start + int(headers["content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} doesn't end where its length says")
        yield headers, data[start:stop]
        at = stop + 4


def http_payload(message: bytes) -> bytes:
    """The body of an HTTP message; chunk framing is undone."""
    head, _, body = message.partition(b"\r\n\r\n")
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    at, parts = 0, []
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        part = body[end + 2 : end + 2 + size]
        if len(part) != size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("broken chunk framing")
        parts.append(part)
        at = end + 4 + size


def _page(urn: str | None) -> int | None:
    name = (urn or "").removeprefix("<urn:page:").partition("#")[0].rstrip(">")
    return int(name) if name not in ("", "null") else None


_RECORD = ("origin string, type string, page_id long, refers_to long, digest string, segment int, total long, block binary, "
           "size long, found string, whole boolean")


def _opened(message: bytes, kind: str, told: str | None) -> tuple[int | None, str | None, bool, bytes]:
    """Payload size and digest of a whole HTTP message, whether it is what the record tells, and the payload.

    A revisit has no payload of its own; its digest is the one it tells.
    """
    try:
        body, whole = http_payload(message), True
    except ValueError:
        body, whole = b"", False
    if kind == "revisit":
        return None, told, whole, body
    found = hashlib.sha256(body).hexdigest()
    return len(body), found, whole and found == told, body


def _records(payloads: bool):
    """The records of archive files. One that has no segments is opened here; only segments travel to where they are joined."""
    kinds = {"origin": pa.string(), "type": pa.string(), "page_id": pa.int64(), "refers_to": pa.int64(), "digest": pa.string(),
             "segment": pa.int32(), "total": pa.int64(), "block": pa.binary(), "size": pa.int64(), "found": pa.string(), "whole": pa.bool_()}

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in items:
            for content in batch.column(0):
                rows: list[list] = [[] for _ in kinds]
                for h, block in parse_records(gzip.decompress(content.as_py())):
                    origin, kind = h.get("warc-segment-origin-id", h["warc-record-id"]), h["warc-type"]
                    told = h.get("warc-payload-digest", "").removeprefix("sha256:") or None
                    total = h.get("warc-segment-total-length")
                    size = found = whole = None
                    if "warc-segment-number" not in h and total is None:
                        size, found, whole, body = _opened(block, kind, told)
                        block = body if payloads else None
                    row = (origin, kind, _page(origin), _page(h.get("warc-refers-to")), told,
                           int(h.get("warc-segment-number", 1)), int(total) if total else None, block, size, found, whole)
                    for column, value in zip(rows, row, strict=True):
                        column.append(value)
                yield batches({n: pa.array(x, kind) for (n, kind), x in zip(kinds.items(), rows, strict=True)})

    return run


def _assembled(payloads: bool):
    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in items:
            size, digest, intact, bodies = [], [], [], []
            for segments, kind, told in zip(*(batch.column(c).to_pylist() for c in ("segments", "type", "digest")), strict=True):
                one = segments[0]
                if len(segments) == 1 and one["whole"] is not None:
                    own = one["size"], one["found"], one["whole"], one["block"]
                else:
                    # A record that isn't a segment has no others beside it.
                    numbers, total = [s["segment"] for s in segments], segments[-1]["total"]
                    message = b"".join(s["block"] or b"" for s in segments)
                    complete = numbers == list(range(1, len(numbers) + 1)) and total == len(message) and all(s["whole"] is None for s in segments)
                    own = _opened(message, kind, told)
                    own = (*own[:2], own[2] and complete, own[3])
                size.append(own[0])
                digest.append(own[1])
                intact.append(own[2])
                bodies.append(own[3] if payloads else None)
            yield batches({"page_id": batch.column("page_id"), "record_type": batch.column("type"), "refers_to": batch.column("refers_to"),
                           "payload_bytes": pa.array(size, pa.int64()), "payload_digest": pa.array(digest, pa.string()),
                           "intact": pa.array(intact, pa.bool_()), "payload": pa.array(bodies, pa.binary())})

    return run


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per response or revisit record: page_id, record_type, refers_to, payload_bytes, payload_digest, intact, payload.

    Continuations are joined to their origin. ``intact`` is false if segments are missing, the total length differs, the
    chunk framing is broken or the payload doesn't have the digest its header tells. ``payload_bytes`` is null for
    revisits; ``resolve_revisits`` fills it. ``payload`` is null unless asked for.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    grouped = map_arrow(files, _records(payloads), _RECORD).groupBy("origin").agg(
        F.max(F.when(F.col("segment") == 1, F.col("type"))).alias("type"), F.max("page_id").alias("page_id"),
        F.max("refers_to").alias("refers_to"), F.max("digest").alias("digest"),
        F.sort_array(F.collect_list(F.struct("segment", "total", "block", "size", "found", "whole"))).alias("segments"))
    return map_arrow(grouped, _assembled(payloads), "page_id long, record_type string, refers_to long, payload_bytes long, "
                     "payload_digest string, intact boolean, payload binary")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """The records with the payload size of each revisit taken from the response it refers to."""
    known = records.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(
        F.max("payload_bytes").alias("known_bytes"))
    joined = records.join(known, ["refers_to", "payload_digest"], "left")
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", "known_bytes")).drop("known_bytes")


def op7_warc_segments(spark, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    records = materialize(read_warc(spark, path).drop("payload"), "warc-records")
    return resolve_revisits(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


OP7_SQL = """
with p as (select page_id, coalesce(html, '') as payload from pages),
d as (select page_id, cast(strlen(payload) as bigint) as payload_bytes, sha256(payload) as payload_digest from p),
f as (select payload_digest, min(page_id) as first from d where payload_bytes >= 100 group by payload_digest having count(*) > 1)
select page_id, payload_bytes, payload_digest,
       case when first is null or page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to, true as intact
from d left join f using (payload_digest)
"""

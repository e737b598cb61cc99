"""WARC archives of pages, with segmented records, revisits and chunked payloads.

Files are gzip-compressed unless told otherwise.

Writing: each page is a record. Of records with equal payloads of at least `least_bytes` bytes the one with the smallest
page id is a response and the others revisit it; smaller ones are all responses. A response's block is an
HTTP response whose body is in chunked transfer framing; a block longer than `segment_bytes` is cut into a first
record and continuation records (WARC-Segment-Origin-ID, WARC-Segment-Number, and WARC-Segment-Total-Length on
the last). Records leave through Spark's text writer with the record end as line separator, so files are plain WARC,
committed by Spark and on any file system that Spark knows; at most `records_per_file` records go into a file.

Reading: files are parsed record by record. Whole responses are decoded where they are read. Segments are grouped by origin
id, put in order of segment number, checked to be complete and of the stated total length, and joined; then the chunked framing
is decoded. A revisit takes its payload's length and digest from the response it refers to.

Defined cases: a null page is an empty payload (a response of no bytes). A null page id is the largest: such a row revisits if any
page with an id has its payload. Rows that repeat page id and payload are each a record of the same type. Urls are percent-escaped
where a header can't hold them; a null url is left out. Other columns are not read. Damaged segments or framing raise
`ValueError` with the record's id. An empty table gives no record.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.llm.common import arrow_map, materialized
from forgeline.session import work_path

LEAST_BYTES = 100
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
RECORDS_PER_FILE = 2_000
WARC_DATE = "2024-01-31T00:00:00Z"
_END = "\r\n\r\n"
_SPACE = uuid.UUID("6f0c5a5e-53c5-4b5c-9d0e-3b1f8f0d7a11")
_HTTP = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

PARSED = ("record_id string, record_type string, page_id long, refers_to long, digest string, origin_id string, "
          "segment_number int, total_length long, block binary, payload binary")


# ------------------------------------------------------------------ one record

def chunked(payload: bytes, chunk_bytes: int = CHUNK_BYTES) -> bytes:
    """Payload in HTTP chunked transfer framing."""
    out = []
    for at in range(0, len(payload), chunk_bytes):
        part = payload[at:at + chunk_bytes]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if the framing is broken or cut short."""
    out, at = [], 0
    while True:
        eol = body.find(b"\r\n", at)
        if eol < 0:
            raise ValueError("chunk without a length")
        n = int(body[at:eol].split(b";")[0], 16)
        at = eol + 2
        if n == 0:
            return b"".join(out)  # trailers, if any, end the body
        if body[at + n:at + n + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        out.append(body[at:at + n])
        at += n + 2


def decoded(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        raise ValueError("HTTP response without end of header")
    return dechunked(body) if re.search(rb"\r\ntransfer-encoding:[ \t]*chunked[ \t]*(\r\n|$)", head, re.I) else body


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def page_records(page_id: int | None, url: str | None, payload: bytes, digest: str, first: tuple | None, seed: str,
                 segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> list[bytes]:
    """The records of one page. `first` is (page id, url) of the response it revisits, or None for a response."""
    name = lambda n: f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}/{seed}/{n}')}>"
    uri = lambda u: None if u is None else quote(u, safe="%/:=&?~#+!$,;'@()*[]")
    common = [("WARC-Date", WARC_DATE), ("WARC-Target-URI", uri(url)), ("X-Page-ID", page_id),
              ("WARC-Payload-Digest", f"sha256:{digest}")]
    if first is not None:
        return [_record([("WARC-Type", "revisit"), ("WARC-Record-ID", name(1)), *common, ("WARC-Profile", _PROFILE),
                         ("WARC-Refers-To-Target-URI", uri(first[1])), ("X-Refers-To-Page-ID", first[0])], b"")]
    block = _HTTP + chunked(payload, chunk_bytes)
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    kind = ("Content-Type", "application/http; msgtype=response")
    if len(parts) == 1:
        return [_record([("WARC-Type", "response"), ("WARC-Record-ID", name(1)), *common, kind], block)]
    out = [_record([("WARC-Type", "response"), ("WARC-Record-ID", name(1)), *common, kind, ("WARC-Segment-Number", 1)], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        out.append(_record([("WARC-Type", "continuation"), ("WARC-Record-ID", name(n)), ("WARC-Date", WARC_DATE),
                            ("WARC-Segment-Origin-ID", name(1)), ("WARC-Segment-Number", n),
                            ("WARC-Segment-Total-Length", len(block) if n == len(parts) else None)], part))
    return out


def inflated(archive: bytes) -> bytes:
    """The archive as plain bytes; gzip files may have any number of members."""
    out = []
    while archive[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(archive))
        archive = member.unused_data
    return b"".join([*out, archive])


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of each record of an archive."""
    at = 0
    while at < len(archive):
        end = archive.find(b"\r\n\r\n", at)
        lines = archive[at:end].decode().split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start, n = end + 4, int(fields["content-length"])
        if archive[start + n:start + n + 4] != b"\r\n\r\n":
            raise ValueError(f"{fields.get('warc-record-id')}: record cut short")
        yield fields, archive[start:start + n]
        at = start + n + 4


# ------------------------------------------------------------------ whole tables

def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least_bytes: int = LEAST_BYTES, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
                   records_per_file: int = RECORDS_PER_FILE, compression: str = "gzip") -> None:
    """Write a record per page, and continuation records, as WARC files below `path`."""
    rows = pages.selectExpr(f"cast(`{id_col}` as bigint) as page_id", f"cast(`{url_col}` as string) as url",
                            f"coalesce(cast(`{html_col}` as string), '') as html"
                            ).withColumn("digest", F.expr("sha2(html, 256)"))
    # only payloads that occur twice or more are joined; one row each after map-side counting
    often = rows.where(f"octet_length(html) >= {least_bytes}").groupBy("digest").agg(
        F.expr("min(if(page_id is null, null, struct(page_id, url))) as first"), F.count("*").alias("n")).where(
        "n > 1").selectExpr("digest as d", "first")
    typed = rows.join(often, rows.digest == often.d, "left").selectExpr(
        "page_id", "url", "html", "digest", "first is not null and not (page_id <=> first.page_id) as revisits",
        "first.page_id as first_id", "first.url as first_url", "cast(monotonically_increasing_id() as string) as seed")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                out = []
                for r in batch.slice(at, 200).to_pylist():
                    first = (r["first_id"], r["first_url"]) if r["revisits"] else None
                    out += page_records(r["page_id"], r["url"], r["html"].encode(), r["digest"], first, r["seed"],
                                        segment_bytes, chunk_bytes)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    # a cut may fall within a character; the writer passes bytes through as they are
    arrow_map(typed, records, "record binary").selectExpr("cast(record as string) as value").write.option(
        "lineSep", _END).option("maxRecordsPerFile", records_per_file).option("compression", compression).text(path)


def _payload(name: str | None, digest: str | None, block: bytes) -> bytes:
    """The decoded payload of a whole response, checked against the record's digest."""
    try:
        payload = decoded(block)
    except ValueError as e:
        raise ValueError(f"{name}: {e}") from e
    if digest is not None and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"{name}: payload differs from its digest")
    return payload


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below `path`; whole responses have their payload, others their block."""
    files = spark.read.format("binaryFile").load(path).select("content")
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()),
                        ("refers_to", pa.int64()), ("digest", pa.string()), ("origin_id", pa.string()),
                        ("segment_number", pa.int32()), ("total_length", pa.int64()), ("block", pa.binary()), ("payload", pa.binary())])

    def number(value: str | None) -> int | None:
        return None if value is None else int(value)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                out, size = [], 0
                for f, block in parse(inflated(batch.column(0)[i].as_py())):
                    name, kind = f.get("warc-record-id"), f.get("warc-type")
                    digest = f.get("warc-payload-digest", "").partition(":")[2] or None
                    segment = number(f.get("warc-segment-number"))
                    whole = kind == "response" and segment is None
                    out.append((name, kind, number(f.get("x-page-id")), number(f.get("x-refers-to-page-id")), digest,
                                f.get("warc-segment-origin-id"), segment, number(f.get("warc-segment-total-length")),
                                None if whole else block, _payload(name, digest, block) if whole else None))
                    size += len(block)
                    if size > 2_000_000:
                        yield batch_of(out)
                        out, size = [], 0
                if out:
                    yield batch_of(out)

    return arrow_map(files, parsed, PARSED)


def reassembled(records: DataFrame) -> DataFrame:
    """Segmented responses put together: record_id, page_id, digest, block. The size of a page bounds a group."""
    segments = records.where("segment_number is not null").selectExpr(
        "coalesce(origin_id, record_id) as record_id", "segment_number", "page_id", "digest", "total_length", "block")
    joined = segments.groupBy("record_id").agg(
        F.expr("max(page_id) as page_id"), F.expr("max(digest) as digest"), F.expr("max(total_length) as total"),
        F.expr("array_sort(collect_list(struct(segment_number, block))) as parts")).selectExpr(
        "record_id", "page_id", "digest", "total", "transform(parts, x -> x.segment_number) as numbers",
        # all parts at once: adding one after the other would copy the page once a segment
        "unhex(array_join(transform(parts, x -> hex(x.block)), '')) as block")
    return joined.selectExpr(
        "record_id", "page_id", "digest",
        "if(numbers = sequence(1, size(numbers)) and octet_length(block) <=> total, block,"
        " cast(raise_error(concat(record_id, ': segments missing or not of the stated total length')) as binary)) as block")


def payloads(records: DataFrame) -> DataFrame:
    """(page_id, payload) of every response, whole or segmented."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([_payload(*r) for r in rows], pa.binary())],
                                             names=["page_id", "payload"])

    whole = records.where("record_type = 'response' and segment_number is null").select("page_id", "payload")
    return whole.unionByName(arrow_map(reassembled(records), decode, "page_id long, payload binary"))


def page_index(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write `pages` as archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = path or work_path(spark, "llm-warc")
    write_archives(pages, path, **options)
    records = read_records(spark, path)
    responses = materialized(payloads(records).selectExpr(
        "page_id", "cast(octet_length(payload) as bigint) as payload_bytes", "sha2(payload, 256) as payload_digest"), "warc-responses")
    return responses.selectExpr("*", "'response' as record_type", "cast(null as bigint) as refers_to").unionByName(resolved(records, responses))


def resolved(records: DataFrame, responses: DataFrame) -> DataFrame:
    """Revisits with the length of the response they name; one whose response is missing is an error."""
    revisits = records.where("record_type = 'revisit'").selectExpr("page_id", "refers_to", "digest")
    # one row per (page, digest) on the right, so a page that many revisit is only large on the left
    known = responses.selectExpr("page_id as r", "payload_bytes", "payload_digest").dropDuplicates(["r", "payload_digest"])
    return revisits.join(known, (revisits.refers_to == known.r) & (revisits.digest == known.payload_digest), "left").selectExpr(
        "page_id", "if(r is null, cast(raise_error(concat('page ', page_id, ': the response it revisits is missing')) as bigint), payload_bytes) as payload_bytes",
        "digest as payload_digest", "'revisit' as record_type", "refers_to")

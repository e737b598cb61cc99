from __future__ import annotations

import gzip
import hashlib
import random

import pytest

from forgeline.llm import warc as W

PAGES = "page_id bigint, url string, html string"


def test_chunked_framing_round_trip_and_damage():
    for payload in (b"", b"x", b"a" * 10_000, "é漢\r\n\r\n0\r\n".encode() * 500):
        for size in (1, 7, 4096):
            assert W.dechunked(W.chunked(payload, size)) == payload
    assert W.dechunked(b"5;ext=1\r\nhello\r\n0\r\nTrailer: x\r\n\r\n") == b"hello"
    for bad in (b"5\r\nhel", b"", b"5\r\nhelloXX0\r\n\r\n"):
        with pytest.raises(ValueError):
            W.dechunked(bad)


def test_parse_takes_what_was_written():
    records = W.page_records(7, "http://x/é?a=b c\r\nX: y", b"p" * 1000, hashlib.sha256(b"p" * 1000).hexdigest(), None, "s", 300, 64)
    archive = b"".join(r + b"\r\n\r\n" for r in records)
    for raw in (archive, gzip.compress(archive), gzip.compress(archive[:500]) + gzip.compress(archive[500:])):
        parsed = list(W.parse(W.inflated(raw)))
        assert [f["warc-type"] for f, _ in parsed] == ["response"] + ["continuation"] * (len(parsed) - 1) and len(parsed) > 3
        assert parsed[0][0]["warc-target-uri"] == "http://x/%C3%A9?a=b%20c%0D%0AX:%20y"
        assert W.decoded(b"".join(b for _, b in parsed)) == b"p" * 1000
    with pytest.raises(ValueError):
        list(W.parse(archive[:-10]))


def rows() -> list[tuple]:
    r = random.Random(1)
    texts = ["", None, "small", "small", "é" * 60, "é" * 60, "<p>\r\n\r\nWARC/1.1\r\n</p>" * 400, "x" * 99, "x" * 99, "y" * 100, "y" * 100]
    texts += ["".join(chr(r.choice([65, 0xE9, 0x6F22, 10, 13])) for _ in range(n)) for n in (1, 5000, 70_000)]
    out = [(100 - i, f"http://h/{i}" if i % 4 else None, t) for i, t in enumerate(texts)]
    return out + [(100 - 9, "http://h/9", "y" * 100), (None, "http://n", "y" * 100), (None, None, "only here" * 20)]


def expected(pages: list[tuple]) -> list[tuple]:
    out = []
    for i, _, t in pages:
        p = (t or "").encode()
        ids = [j for j, _, u in pages if (u or "").encode() == p and j is not None]
        first = min(ids) if ids and len(p) >= 100 else i
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "response" if i == first else "revisit", None if i == first else first))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"segment_bytes": 500, "chunk_bytes": 33, "records_per_file": 3, "compression": "none"}])
def test_pages_round_trip(spark, tmp_dir, options):
    pages = spark.createDataFrame(rows(), PAGES).selectExpr("*", "1 as digest", "'x' as first", "2 as seed").repartition(3)
    path = f"{tmp_dir}/{len(options)}"
    got = sorted((tuple(r) for r in W.page_index(pages, path, **options).collect()), key=str)
    assert got == expected(rows())
    payloads = sorted((bytes(r.payload) for r in W.payloads(W.read_records(spark, path)).where("page_id = 88").collect()))
    assert payloads == [(next(t for i, _, t in rows() if i == 88)).encode()]


def test_missing_segment_is_refused(spark, tmp_dir):
    pages = spark.createDataFrame([(1, None, "z" * 3000)], PAGES)
    W.write_archives(pages, f"{tmp_dir}/a", segment_bytes=500)
    records = W.read_records(spark, f"{tmp_dir}/a")
    assert W.payloads(records).count() == 1
    for damage in ("coalesce(segment_number, 0) <> 3", "coalesce(segment_number, 0) <> 7"):
        with pytest.raises(Exception, match="segments missing"):
            W.reassembled(records.where(damage)).collect()


def test_a_large_page_of_many_segments(spark, tmp_dir):
    """300,000 characters in parts of 200 bytes come back whole."""
    r = random.Random(8)
    text = "".join(chr(r.choice([65, 0xE9, 0x6F22, 10])) for _ in range(300_000))
    pages = spark.createDataFrame([(1, None, text), (2, None, text), (3, None, "short")], PAGES)
    got = {x.page_id: tuple(x) for x in W.page_index(pages, f"{tmp_dir}/large", segment_bytes=200).collect()}
    size, digest = len(text.encode()), hashlib.sha256(text.encode()).hexdigest()
    assert got[1] == (1, size, digest, "response", None) and got[2] == (2, size, digest, "revisit", 1)


def test_a_revisit_without_its_response_is_refused(spark, tmp_dir):
    pages = spark.createDataFrame([(1, None, "z" * 300), (2, None, "z" * 300)], PAGES)
    path = f"{tmp_dir}/lost"
    W.write_archives(pages, path)
    records = W.read_records(spark, path)
    with pytest.raises(Exception, match="revisits is missing"):
        W.resolved(records.where("record_type = 'revisit'"), spark.createDataFrame([], "page_id bigint, payload_bytes bigint, payload_digest string")).collect()
    assert W.resolved(records.where("record_type = 'revisit'"), spark.createDataFrame(
        [(1, 300, hashlib.sha256(b"z" * 300).hexdigest())], "page_id bigint, payload_bytes bigint, payload_digest string")).count() == 1


def test_empty_table(spark):
    assert W.page_index(spark.createDataFrame([], PAGES)).count() == 0

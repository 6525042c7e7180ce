"""Web archives: the query against SQL, exact round trips, and broken input."""

import gzip
import hashlib

import pytest

from compare import connect, difference
from eventlode.llm.warc import OP7_SQL, http_payload, member, op7_warc_segments, parse_records, read_warc, resolve_revisits, write_warc


def test_query_against_sql(spark, sf_dir):
    assert difference(spark, connect(sf_dir), op7_warc_segments, OP7_SQL, sf_dir) is None


def test_round_trip(spark, tmp_path):
    nasty = "WARC/1.1\r\nWARC-Type: response\r\n\r\n0\r\n\r\n" + "é😀" * 60_000 + "\r\n\r\n"
    pages = [(1, "http://a/\r\nX: y", nasty), (2, None, ""), (3, "u", None), (4, "u", "x" * 99), (5, "u", "x" * 99), (6, "u", "y" * 100),
             (7, "u", "y" * 100), (8, "u", nasty), (None, "u", "y" * 100), (6, "u", "y" * 100), (9, "u", "\r\n" * 40_000)]
    frame = spark.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, html string, payload string")
    write_warc(frame, str(tmp_path / "w"))
    records = read_warc(spark, str(tmp_path / "w"), payloads=True)
    found = resolve_revisits(records).collect()
    assert len(found) == len(pages) and all(r.intact for r in found)
    for r in found:
        html = next((p[2] or "").encode() for p in pages if p[0] == r.page_id)
        assert r.payload_bytes == len(html) and r.payload_digest == hashlib.sha256(html).hexdigest()
        assert r.record_type == "revisit" or r.payload == html
    assert sorted((r.page_id or 0, r.refers_to) for r in found if r.record_type == "revisit") == [(0, 6), (7, 6), (8, 1)]
    kinds = [h["warc-type"] for f in (tmp_path / "w").glob("part-*") for h, _ in parse_records(gzip.decompress(f.read_bytes()))]
    assert kinds.count("continuation") >= 5
    heads = [h for f in (tmp_path / "w").glob("part-*") for h, _ in parse_records(gzip.decompress(f.read_bytes()))]
    names = [h["warc-record-id"] for h in heads]
    stored = {h["warc-record-id"]: h["warc-payload-digest"] for h in heads if h["warc-type"] == "response"}
    revisits = [h for h in heads if h["warc-type"] == "revisit"]
    assert len(set(names)) == len(names) and len(revisits) == 3
    assert all(stored[h["warc-refers-to"]] == h["warc-payload-digest"] and h["warc-profile"].endswith("identical-payload-digest") for h in revisits)


def test_records_can_be_sought(spark, tmp_path):
    import zlib

    pages = [(k, f"http://host/{k}", "é😀" * (k * 5_000)) for k in range(8)]
    write_warc(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"))
    (file,) = (tmp_path / "w").glob("part-*")
    data, at, starts = file.read_bytes(), 0, []
    while at < len(data):
        one = zlib.decompressobj(wbits=31)
        plain = one.decompress(data[at:]) + one.flush()
        # Each member is one whole record, read from its own offset.
        assert one.eof and len(list(parse_records(plain))) == 1
        starts.append(at)
        at = len(data) - len(one.unused_data)
    assert len(starts) == sum(1 for _ in parse_records(gzip.decompress(data))) > len(pages)


def test_member_ends_in_zero():
    for data in (b"", b"x", b"y" * 70_000, b"z" * (1 << 24)):
        packed = member(data)
        assert packed[-1] == 0 and gzip.decompress(packed) == data


def test_empty_table(spark, tmp_path):
    write_warc(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w"))
    assert read_warc(spark, str(tmp_path / "w")).count() == 0


def test_missing_segment(spark, tmp_path):
    write_warc(spark.createDataFrame([(1, "u", "z" * 200_000)], "page_id long, url string, html string"), str(tmp_path / "w"))
    (file,) = (tmp_path / "w").glob("part-*")
    data = gzip.decompress(file.read_bytes())
    at = [i for i in range(len(data)) if data.startswith(b"WARC/1.1\r\n", i)]
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "a.gz").write_bytes(gzip.compress(data[: at[2]] + data[at[3] :]))
    assert [r.intact for r in read_warc(spark, str(tmp_path / "cut")).collect()] == [False]


def test_chunk_framing():
    assert http_payload(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3;x=y\r\nabc\r\n2\r\nde\r\n0\r\n\r\n") == b"abcde"
    assert http_payload(b"HTTP/1.1 200 OK\r\n\r\nabc") == b"abc"
    with pytest.raises(ValueError):
        http_payload(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n9\r\nabc\r\n0\r\n\r\n")

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from pathlib import Path

import pytest

from spanvec.llm import warc

SCHEMA = "page_id bigint, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


PAGES = [
    (1, "http://a/1", "<p>é日本</p>\r\n\r\nWARC/1.1\r\n" * 50), (2, "http://a/2", "x" * 100_000), (3, "http://a/3", "x" * 100_000), (4, None, None),
    (5, "http://a/5", ""), (6, "http://a\r\nWARC-Type: y", "0\r\n\r\n"), (7, "", "ß" * 33_333), (7, "", "ß" * 33_333), (8, "u", "ß" * 33_333),
    (None, "n", "only here"), (None, "n", ""), (9, "v", "\r\n\r\n"),
]


@pytest.mark.parametrize("sizes", [{}, {"segment_bytes": 700, "chunk_bytes": 90}, {"least_bytes": 10}])
def test_round_trip(spark, sizes):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    for frame in (pages, pages.selectExpr("*", "1 as sha", "2 as first", "3 as token", "4 as value", "5 as error")):
        rows = warc.round_trip(frame, with_payload=True, **sizes).collect()
        least = sizes.get("least_bytes", 0)
        want = []
        for page, url, html in PAGES:
            text = html or ""
            same = [p for p, _, h in PAGES if (h or "") == text and p is not None] if len(text.encode()) >= least else []
            first = min(same, default=None)
            first = first if first is not None and (page is None or page > first) else None
            shown = url and url.replace("\r", "%0D").replace("\n", "%0A")
            want.append((page, shown or None, text, len(text.encode()), digest(text), "revisit" if first is not None else "response", first, None))
        got = [(r.page_id, r.url or None, r.html, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.error) for r in rows]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_archives_are_segmented_and_valid(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(2)
    warc.write_pages(pages, str(tmp_path / "w"), segment_bytes=1000, chunk_bytes=100)
    kinds, segments = {}, {}
    for file in Path(tmp_path / "w").glob("*.gz"):
        data = gzip.decompress(file.read_bytes())
        for fields, block in warc.records(io.BytesIO(data)):
            kinds[fields["warc-type"]] = kinds.get(fields["warc-type"], 0) + 1
            assert len(block) <= 1003 and len(block) == int(fields["content-length"])
            if "warc-segment-number" in fields:
                segments.setdefault(fields.get("warc-segment-origin-id", fields["warc-record-id"]), []).append((int(fields["warc-segment-number"]), block, fields.get("warc-segment-total-length")))
    assert kinds["revisit"] == 4 and kinds["response"] == 8 and kinds["continuation"] > 200
    for parts in segments.values():
        parts.sort(key=lambda p: p[0])
        assert [p[0] for p in parts] == list(range(1, len(parts) + 1))
        assert [p[2] for p in parts[:-1]] == [None] * (len(parts) - 1) and int(parts[-1][2]) == sum(len(p[1]) for p in parts)


def test_faults_are_reported(spark, tmp_path):
    made = warc.page_records(1, "u", "y" * 5000, None, digest("y" * 5000), 1, segment_bytes=1000, chunk_bytes=100)
    other = warc.page_records(2, "u", "z" * 10, None, digest("other"), 2, segment_bytes=1000, chunk_bytes=100)
    lost = warc.page_records(3, "u", "q", 99, digest("q"), 3, segment_bytes=1000, chunk_bytes=100)
    bad = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<x>"), ("X-Page-Id", 4)], b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n9\r\nabc\r\n0\r\n\r\n")
    plain = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<y>"), ("X-Page-Id", 5)], b"HTTP/1.1 200 OK\r\n\r\nbody")
    folder = tmp_path / "w"
    folder.mkdir()
    records = made[:2] + made[3:] + other + lost + [bad, plain]
    (folder / "a.warc.gz").write_bytes(gzip.compress(b"".join(r + b"\r\n\r\n" for r in records)))
    (folder / "empty.warc.gz").write_bytes(gzip.compress(b""))
    rows = {r.page_id: r for r in warc.read_pages(spark, str(folder)).collect()}
    assert rows["1"].error == "a segment is missing or repeated" and rows["2"].error == "the digest is another"
    assert rows["3"].error == "the referred record is missing" and rows["4"].error == "chunk of a wrong length"
    assert rows["5"].error is None and rows["5"].html == "body"


def test_framing():
    for size in (1, 2, 3, 7, 1000):
        for data in ("", "a", "日本é" * 20, "0\r\n\r\n"):
            assert warc.dechunked(warc.chunked(data.encode(), size)) == data.encode()
    assert warc.dechunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0

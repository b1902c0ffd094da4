"""WARC archives of pages: written with segments and revisits, read back by reassembly.

A page is an HTTP response with chunked transfer framing. A block longer than
``segment_bytes`` becomes a first record and continuation records, which may lie
anywhere in the archives. The reader groups continuations by the identifier of
their origin, orders them by segment number, checks that the numbers have no gap and
the total length is the stated one, takes the chunked framing off, and checks the
payload's digest. Of equal payloads only the page with the smallest id is stored;
the others are revisit records that refer to it.

Archives are gzip files written by Spark's text sink: a record ends with the line
separator, two line breaks, which is what the format asks for. Blocks and chunks are
cut between characters, so every record is valid UTF-8.

Defined results for odd input: a NULL payload is an empty one; a page without an id
is a response unless a page with an id has the same payload; repeated rows with the
smallest id are responses each; a URL may be missing, and line breaks in it are
percent-encoded; an empty table makes archives without records; other columns are
not stored. A record that fails a check is returned with its ``error``, never dropped.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanvec.llm.labelled import texts_of
from spanvec.session import materialize, shared_dir

RECORD_END = "\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 2000


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def cut(data: bytes, size: int) -> list[bytes]:
    """Runs of at most ``size`` bytes (3 more at most) that end between characters."""
    out, at = [], 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        out.append(data[at:end])
        at = end
    return out


def chunked(payload: bytes, size: int) -> bytes:
    return b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in cut(payload, size)) + b"0\r\n\r\n"


def dechunked(data: bytes) -> bytes:
    """The payload without chunk sizes, extensions and trailers."""
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk without a size")
        size = int(data[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if data[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk of a wrong length")
        out.append(data[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP response, unframed if the head says so."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no HTTP head")
    return dechunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head.replace(b"\r", b"")) else body


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def page_records(page_id, url: str | None, html: str | None, first, digest: str, token: int, *, segment_bytes: int, chunk_bytes: int) -> list[bytes]:
    """All records of a page; ``first`` is the page with the same payload that it revisits."""
    name = f"urn:x-page:{'none' if page_id is None else page_id}"
    own = f"<{name}#{token}>"
    uri = url and re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url)
    common = [("WARC-Target-URI", uri), ("WARC-Date", DATE), ("X-Page-Id", page_id)]
    if first is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        kind = [("WARC-Type", "revisit"), ("WARC-Record-ID", own), ("WARC-Refers-To", f"<urn:x-page:{first}>"), ("WARC-Profile", profile)]
        return [record([*kind, *common, ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")], HTTP_HEAD[:-2] + b"\r\n")]
    block = HTTP_HEAD + chunked((html or "").encode(), chunk_bytes)
    parts = cut(block, segment_bytes)
    out = []
    for number, part in enumerate(parts, 1):
        kind = "response" if number == 1 else "continuation"
        fields = [("WARC-Type", kind), ("WARC-Record-ID", own if number == 1 else f"<{name}#{token}.{number}>"), *common]
        if number == 1:
            fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
        if len(parts) > 1:
            fields.append(("WARC-Segment-Number", number))
            if number > 1:
                fields.append(("WARC-Segment-Origin-ID", own))
            if number == len(parts):
                fields.append(("WARC-Segment-Total-Length", len(block)))
        out.append(record(fields, part))
    return out


def records(source: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, names in lower case, and block of each record of a stream."""
    while line := source.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = {}
        while (line := source.readline()).strip():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            fields[key.strip().lower()] = value.strip()
        block = source.read(int(fields["content-length"]))
        if len(block) < int(fields["content-length"]):
            raise ValueError("truncated record")
        yield fields, block


def write_pages(pages: DataFrame, path: str, *, least_bytes: int = 0, segment_bytes: int = 1 << 15, chunk_bytes: int = 1 << 12) -> None:
    """Archives of ``page_id, url, html``; payloads of ``least_bytes`` or more are stored once."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    named = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("html"))
    named = named.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    ids = named.where(F.octet_length("html") >= least_bytes).select("page_id", "sha")
    firsts = ids.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    again = ids.join(firsts, "sha").where("page_id is null or page_id > first")
    again = materialize(again.select(F.col("page_id").alias("_id"), F.col("sha").alias("_sha"), "first").distinct())
    same = named["page_id"].eqNullSafe(again["_id"]) & (named["sha"] == again["_sha"])
    rows = named.join(again, same, "left").select("html", "page_id", "url", "first", "sha", F.monotonically_increasing_id().alias("token"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in texts_of(batches, 0):
            out = []
            for html, page, url, first, sha, token in zip(texts, *(part.column(i).to_pylist() for i in range(1, 6)), strict=True):
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                out += page_records(page, url, html, first, digest, token, segment_bytes=segment_bytes, chunk_bytes=chunk_bytes)
            yield pa.RecordBatch.from_pydict({"value": pa.array([r.decode() for r in out], pa.string())})

    made = rows.mapInArrow(run, "value string")
    made.write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


_PIECES = "record_type string, page_id string, url string, refers_to string, digest string, origin string, segment int, total bigint, block binary"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _PIECES.split(", ")]
    kinds = [pa.string()] * 6 + [pa.int32(), pa.int64(), pa.binary()]
    for batch in batches:
        for content in batch.column(0):
            rows, size = [], 0
            with gzip.open(io.BytesIO(content.as_buffer())) as source:
                for fields, block in records(source):
                    refers = re.fullmatch(r"<urn:x-page:([^#>]*)>", fields.get("warc-refers-to", ""))
                    rows.append((
                        fields["warc-type"], fields.get("x-page-id"), fields.get("warc-target-uri"), refers and refers[1],
                        fields.get("warc-payload-digest"), fields.get("warc-segment-origin-id", fields["warc-record-id"]),
                        int(fields.get("warc-segment-number", 0)), int(fields["warc-segment-total-length"]) if "warc-segment-total-length" in fields else None, block,
                    ))
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _decode(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, errors, texts = [], [], [], []
            given = batch.column(4).to_pylist()
            for want, segments, total, blocks in zip(given, *(batch.column(i).to_pylist() for i in (5, 6, 7)), strict=True):
                try:
                    if segments != [0] and segments != list(range(1, len(segments) + 1)):
                        raise ValueError("a segment is missing or repeated")
                    block = b"".join(blocks)
                    if segments != [0] and total != len(block):
                        raise ValueError("the total length is another")
                    payload = payload_of(block)
                    digest = payload_digest(payload)
                    if want not in (None, f"sha1:{digest}"):
                        raise ValueError("the digest is another")
                    sizes.append(len(payload))
                    digests.append(digest)
                    errors.append(None)
                    texts.append(payload.decode("utf-8", "replace") if with_payload else None)
                except ValueError as e:
                    for column, value in ((sizes, None), (digests, None), (errors, str(e)), (texts, None)):
                        column.append(value)
            columns = {name: batch.column(i) for i, name in enumerate(("record_type", "page_id", "url", "refers_to"))}
            columns |= {"payload_bytes": pa.array(sizes, pa.int64()), "payload_digest": pa.array(digests, pa.string()), "error": pa.array(errors, pa.string())}
            yield pa.RecordBatch.from_pydict(columns | ({"html": pa.array(texts, pa.string())} if with_payload else {}))

    return run


def read_pages(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload_bytes, payload_digest, error`` and, if asked for, ``html``.

    Only records that have segments are grouped: a group is one page.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    pieces = files.mapInArrow(_read, _PIECES)
    alone = pieces.where("segment = 0 and record_type <> 'revisit'").select(
        "record_type", "page_id", "url", "refers_to", "digest", F.array("segment").alias("segments"), "total", F.array("block").alias("blocks")
    )
    cut_up = pieces.where("segment > 0").groupBy("origin")
    item = F.sort_array(F.collect_list(F.struct("segment", "block")))
    first = [F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in ("page_id", "url", "refers_to", "digest")]
    joined = cut_up.agg(*first, F.max("total").alias("total"), item.alias("items"))
    joined = joined.select(
        F.lit("response").alias("record_type"), "page_id", "url", "refers_to", "digest", F.col("items.segment").alias("segments"), "total", F.col("items.block").alias("blocks")
    )
    schema = "record_type string, page_id string, url string, refers_to string, payload_bytes bigint, payload_digest string, error string" + ", html string" * with_payload
    decode = _decode(with_payload)
    responses = alone.mapInArrow(decode, schema).unionByName(joined.mapInArrow(decode, schema))
    responses = materialize(responses)
    revisits = pieces.where("record_type = 'revisit'").select("record_type", "page_id", "url", "refers_to", F.regexp_replace("digest", "^sha1:", "").alias("_digest"))
    stored = responses.groupBy(F.col("page_id").alias("_page"), F.col("payload_digest").alias("_found")).agg(
        F.max("payload_bytes").alias("payload_bytes"), *([F.max("html").alias("html")] if with_payload else [])
    )
    met = (F.col("refers_to") == F.col("_page")) & (F.col("_digest") == F.col("_found"))
    lost = F.when(F.col("_found").isNull(), F.lit("the referred record is missing"))
    again = revisits.join(stored, met, "left").withColumn("error", lost).withColumnRenamed("_digest", "payload_digest").drop("_page", "_found")
    return responses.unionByName(again)


def round_trip(pages: DataFrame, *, with_payload: bool = False, **options) -> DataFrame:
    """Pages written to archives in the shared folder and read from there; ``page_id`` has its own type again."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_pages(pages, path, **options)
    kind = dict(pages.dtypes)["page_id"]
    found = read_pages(spark, path, with_payload=with_payload)
    return found.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))

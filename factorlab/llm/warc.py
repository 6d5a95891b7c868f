"""WARC archives: writer and splittable reader (operator 9).

Writing: payloads that repeat (equal SHA-256, ``min_revisit`` bytes or more) are stored once; the
record with the smallest page_id is the response, the others are revisits that refer to it.
Every task writes its own archive, one gzip member per record, under a fresh name in the
shared folder; the written list of names is what counts, so a lost or repeated task leaves at most
an unlisted file.

Reading: archives are cut into byte ranges and a task owns the records that start in its range. It
scans for the gzip magic, and a candidate counts only if its member inflates to a WARC header
and the whole record inflates with a valid checksum and the announced length. The record is read to
its end, also beyond the range, and the scan goes on behind it. A task holds one record and one
chunk of the file.

Defined cases: null html is an empty payload; a null url has no target; null page_ids make records
without an id (a revisit if another page has the payload, and a response if no page with it has an
id); repeated rows of the smallest page_id are all responses; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factorlab.llm.common import shared_folder, slices, written

MIN_REVISIT = 100
RANGE_BYTES = 8 << 20
CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "urn:x-page:"


def open_folder(location: str):
    """File system and path of a location in shared storage (any scheme that pyarrow knows)."""
    from pyarrow import fs

    if location.startswith("file:"):
        return fs.LocalFileSystem(), "/" + location.removeprefix("file:").lstrip("/")
    if "://" in location:
        return fs.FileSystem.from_uri(location)
    return fs.LocalFileSystem(), location


# ------------------------------------------------------------------ records

def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One uncompressed WARC record; a revisit keeps the HTTP header but not the payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {DATE}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <{_RECORD}{page_id}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._')}")
    if revisit:
        head += [f"WARC-Refers-To: <{_RECORD}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parse(data: bytes) -> dict | None:
    """Fields of one whole record, or None if it is not a WARC record of the announced length."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or not lines[0].startswith("WARC/"):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    length = fields.get("content-length", "")
    if not length.isdigit() or len(rest) != int(length) + 4 or not rest.endswith(b"\r\n\r\n"):
        return None
    http, mark, payload = rest[:-4].partition(b"\r\n\r\n")
    sizes = [line.partition(":")[2].strip() for line in http.decode("latin-1").split("\r\n")
             if line.lower().startswith("content-length:")]
    reference = lambda key: fields[key].strip("<>").removeprefix(_RECORD) if key in fields else None
    return {"type": fields.get("warc-type"), "page_id": reference("warc-record-id"), "url": fields.get("warc-target-uri"),
            "refers_to": reference("warc-refers-to"), "digest": fields.get("warc-payload-digest", "").removeprefix("sha256:"),
            "payload": payload, "payload_bytes": int(sizes[0]) if sizes else len(payload)}


def read_range(source, size: int, start: int, stop: int, chunk: int = CHUNK) -> Iterator[tuple[int, dict]]:
    """``(offset, record)`` for the records that start in ``[start, stop)`` of a seekable file."""
    def window(at: int) -> bytes:
        source.seek(at)
        return source.read(min(chunk, size - at))

    def inflate(at: int) -> tuple[int, dict] | None:
        unpacker, parts, place, checked = zlib.decompressobj(31), [], at, False
        try:
            while not unpacker.eof and place < size:
                data = window(place)
                place += len(data)
                parts.append(unpacker.decompress(data))
                if not checked and sum(map(len, parts)) >= 5:
                    if not b"".join(parts).startswith(b"WARC/"):
                        return None
                    checked = True
        except zlib.error:
            return None
        found = parse(b"".join(parts)) if unpacker.eof else None
        return found and (place - len(unpacker.unused_data), found)

    at = start
    while at < stop:
        data = window(at)
        hit = data.find(MAGIC)
        if hit < 0:
            at += max(1, len(data) - len(MAGIC) + 1)   # the magic may lie across two chunks
            continue
        at += hit
        if at >= stop:
            return
        if result := inflate(at):
            end, found = result
            yield at, found
            at = end
        else:
            at += 1


# ------------------------------------------------------------------ Spark plan

def with_references(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``(page_id, url, html, digest, refers_to)``; ``refers_to`` is null for responses."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    base = base.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    firsts = (base.filter(F.octet_length("html") >= min_revisit).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .filter("n > 1").select(F.col("digest").alias("_digest"), "first"))
    refers = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to")
    return base.join(firsts, F.col("digest") == F.col("_digest"), "left").select("page_id", "url", "html", "digest", refers)


def write_archives(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write all pages as archives below ``folder``, one per task; returns ``(path, bytes, records)``."""
    def run(batches):
        system, path = open_folder(folder)
        name = f"pages-{uuid.uuid4().hex}.warc.gz"
        system.create_dir(path, recursive=True)
        sink, count, size = None, 0, 0
        for part in slices(batches):
            for page, url, html, digest, refers in zip(*(c.to_pylist() for c in part.columns)):
                sink = sink or system.open_output_stream(f"{path}/{name}", compression=None)
                data = member(record(page, url, html.encode("utf-8", "surrogatepass"), digest, refers))
                sink.write(data)
                count, size = count + 1, size + len(data)
        if sink:
            sink.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [size], "records": [count]})

    records = with_references(pages, min_revisit)
    return written(records.mapInArrow(run, "path string, bytes long, records long"), "archives")


def read_archives(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per record of ``archives(path, bytes)``: ids, type, url, digest, sizes and payload."""
    number = lambda v: int(v) if v not in (None, "") else None
    types = {"path": pa.string(), "offset": pa.int64(), "page_id": pa.int64(), "record_type": pa.string(),
             "url": pa.string(), "refers_to": pa.int64(), "payload_digest": pa.string(), "digest_valid": pa.bool_(),
             "payload_bytes": pa.int64(), "payload": pa.binary()}

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], list(types))

    def run(batches):
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                system, place = open_folder(path)
                rows, held = [], 0
                with system.open_input_file(place) as source:
                    for offset, r in read_range(source, size, start, min(start + range_bytes, size)):
                        actual = hashlib.sha256(r["payload"]).hexdigest() if r["type"] == "response" else r["digest"]
                        rows.append((path, offset, number(r["page_id"]), r["type"], r["url"], number(r["refers_to"]),
                                     actual, actual == r["digest"], r["payload_bytes"], r["payload"]))
                        held += len(r["payload"])
                        if len(rows) >= 256 or held >= CHUNK:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    ranges = archives.select("path", F.col("bytes").cast("long").alias("bytes"), starts.alias("start"))
    spark: SparkSession = archives.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, ranges.count())
    return ranges.repartition(min(tasks, 100_000), "path", "start").mapInArrow(
        run, "path string, offset long, page_id long, record_type string, url string, refers_to long, "
             "payload_digest string, digest_valid boolean, payload_bytes long, payload binary")


def round_trip(pages: DataFrame, range_bytes: int = RANGE_BYTES, **options) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    return read_archives(write_archives(pages, folder, **options), range_bytes)


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM firsts
"""

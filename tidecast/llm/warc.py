"""WARC archives: write one compressed record per page, index first, and read selected records
back by coalesced sorted byte ranges.

``write_archives`` stores each page in one ``.warc.gz`` file per task, every record its own gzip
member, and returns the index: file, offset, length, url, payload digest, record type.
``read_records`` sorts the selected index rows by file and offset, joins neighbours whose gap
is small into one byte range, and reads each range once.

Of the pages with equal payloads that with the largest id is the ``response``; the others are
``revisit`` records that refer to it.  Payloads below ``least`` bytes are all responses.

Defined results: a null html is an empty payload and counts as one; a null url is written as
an empty target; rows that repeat a page id with its payload are each written (as responses
if that id is the largest); a null page id never is a response that others refer to while an
id exists; empty tables give no records; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import _shared as S

#: Neighbours with a gap of at most this many bytes are read together, up to RANGE_BYTES.
GAP_BYTES, RANGE_BYTES = 64 << 10, 8 << 20

INDEX_SCHEMA = "page_id long, url string, digest string, record_type string, refers_to long, file string, offset long, length long"
RECORD_SCHEMA = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def with_record_types(pages: DataFrame, least: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to``; refers_to is null for responses.

    Payload groups are reduced on (digest, largest id) before the shuffle, so a payload that
    a third of all pages share is one row per task; the join back has one row per digest and
    is split by AQE where a digest is hot.
    """
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                       F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    src = src.withColumn("sha", F.unhex(F.sha1("payload")))
    top = src.groupBy("sha").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("sha", "top")
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top")) & (F.length("payload") >= least)
    return src.join(top, "sha", "left").select("page_id", "url", "payload", "sha", F.when(revisit, F.col("top")).alias("refers_to"))


def _record(page_id, url: str, payload: bytes, sha: bytes, refers_to) -> tuple[bytes, str]:
    """One WARC/1.1 record (uncompressed) and its digest."""
    digest = base64.b32encode(sha).decode()
    # a line break in a url would end the header line
    url = re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    head = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>".encode(), b"WARC-Date: 1970-01-01T00:00:00Z",
            b"WARC-Target-URI: " + url.encode(), b"WARC-Payload-Digest: sha1:" + digest.encode(),
            b"X-Payload-Length: %d" % len(payload), b"Content-Type: text/html; charset=utf-8"]
    if refers_to is not None:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: <urn:page:%d>" % refers_to]
        payload = b""
    head.append(b"Content-Length: %d" % len(payload))
    return b"\r\n".join(head) + b"\r\n\r\n" + payload + b"\r\n\r\n", digest


def write_archives(pages: DataFrame, folder: str, least: int = 0, level: int = 6) -> DataFrame:
    """Write the archives below ``folder`` and return the index (written there as well).

    A file belongs to one task and is moved into place when whole, so a task that is run
    again replaces its file by an equal one.
    """
    spark = pages.sparkSession
    S.prepare(spark)

    def write(batches):
        from pyspark import TaskContext
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}.warc.gz"
        index = []

        def fill(out):
            at = 0
            for b in batches:
                for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    raw, digest = _record(*row)
                    z = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = z.compress(raw) + z.flush()
                    out.write(member)
                    index.append((row[0], row[1], digest, "response" if row[4] is None else "revisit", row[4], name, at, len(member)))
                    at += len(member)

        first = next(batches, None)
        if first is None:
            return
        from itertools import chain
        batches = chain([first], batches)
        S.put_file(folder, name, fill)
        for i in range(0, len(index), 10_000):
            cols = list(zip(*index[i:i + 10_000], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                names=["page_id", "url", "digest", "record_type", "refers_to", "file", "offset", "length"])

    rows = with_record_types(pages, least)
    S.write(rows.mapInArrow(write, INDEX_SCHEMA), f"{folder}/index")
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")


def byte_ranges(index: DataFrame, gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> DataFrame:
    """(file, start, end, records): the selected records' ranges, neighbours coalesced.

    The window runs within one file, whose records one task wrote, so its size is bounded.
    """
    w = Window.partitionBy("file").orderBy("offset")
    far = F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(w) > gap
    cell = F.floor(F.col("offset") / most)
    new = F.when(far | (cell != F.lag(cell).over(w)), 1).otherwise(0)
    return (index.select("file", "offset", "length", new.alias("new")).withColumn("range", F.sum("new").over(w))
            .groupBy("file", "range").agg(F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("end"),
                                          F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("records")))


def parse_record(raw: bytes) -> dict:
    """Header fields (lower-case names) and block of one WARC record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    fields = {k.strip().lower().decode(): v.strip().decode() for k, _, v in (x.partition(b":") for x in lines[1:])}
    n = int(fields["content-length"])
    if len(rest) < n:
        raise ValueError("the record is cut short")
    return fields | {"block": rest[:n]}


def read_records(index: DataFrame, folder: str, gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> DataFrame:
    """The records that ``index`` selects.  Digest and length of a response are computed from
    the bytes read and must equal its header; a revisit holds them in its header only."""
    spark = index.sparkSession
    S.prepare(spark)

    def page(ref: str | None):
        ref = (ref or "")[len("<urn:page:"):-1]
        return int(ref) if ref else None

    def read(batches):
        f, base = S.filesystem(folder)
        for b in batches:
            for file, start, end, records in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with f.open_input_file(f"{base}/{file}") as source:
                    blob = source.read_at(end - start, start)
                out = []
                for r in records:
                    at = r["offset"] - start
                    rec = parse_record(zlib.decompress(blob[at:at + r["length"]], 31))
                    digest = rec["warc-payload-digest"].removeprefix("sha1:")
                    size, payload = int(rec["x-payload-length"]), None
                    if rec["warc-type"] == "response":
                        payload = rec["block"]
                        if (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()) != (size, digest):
                            raise ValueError(f"{file} at {r['offset']}: payload does not match its digest")
                    out.append((page(rec["warc-record-id"]), rec["warc-target-uri"], payload, size, digest, rec["warc-type"], page(rec.get("warc-refers-to"))))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)],
                    names=["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return byte_ranges(index, gap, most).select("file", "start", "end", "records").mapInArrow(read, RECORD_SCHEMA)


def op2_warc(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op2: every page written to the archives and read back from them."""
    folder = S.shared_dir(spark, "warc")
    index = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_records(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: SHA-1 to base32 in SQL: the digest's 160 bits as 32 groups of five.
ORACLE_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS hex FROM pages),
top AS (SELECT hex, max(page_id) AS top FROM p GROUP BY hex),
bits AS (SELECT hex, array_to_string(list_transform(range(0, 40), lambda i: lpad(bin(instr('0123456789abcdef', hex[i + 1]) - 1), 4, '0')), '') AS s FROM top)
SELECT p.page_id, octet_length(p.b)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: ('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')[1 + 16 * (s[5 * i + 1] = '1')::INT + 8 * (s[5 * i + 2] = '1')::INT
    + 4 * (s[5 * i + 3] = '1')::INT + 2 * (s[5 * i + 4] = '1')::INT + (s[5 * i + 5] = '1')::INT]), '') AS payload_digest,
  CASE WHEN p.page_id = top.top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id = top.top THEN NULL ELSE top.top END AS refers_to
FROM p JOIN top USING (hex) JOIN bits USING (hex)
"""

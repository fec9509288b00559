"""WARC archives, index first.

Writing: every partition appends gzip members to one archive in a shared
folder; each record gives one index row (archive, offset, length, url,
digest). The archive has a name of the task attempt's own, so the index of
attempts that counted never points into another attempt's file.

Reading: index rows are chosen first (any filter on them), sorted by archive
and offset, and neighbouring byte ranges are read in one request.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .components import stored

#: Bytes between two ranges that are read along rather than skipped.
GAP = 64 << 10
#: Most bytes of one request, unless a single record is longer.
REQUEST = 8 << 20
#: Part of an archive that one read task takes.
STRIPE = 64 << 20

#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "<urn:page:{}>"

INDEX = "page_id bigint, archive string, offset bigint, length bigint, url string, digest string, record_type string"
RECORDS = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
           "url string, payload binary")


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if ":/" in uri else (pafs.LocalFileSystem(), uri)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, digest: str, size: int, refers_to=None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record; a revisit keeps the HTTP head and leaves the payload out.
    Signs that would break a header line are percent-encoded."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {RECORD_ID.format(page_id)}",
            f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {RECORD_ID.format(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(record head, HTTP head, payload) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Archives of ``pages`` (page_id, url, html, refers_to); index rows.
    Lazy: store the result once, each run writes the archives again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = path = None
        at = 0
        for rb in batches:
            if sink is None:
                fs, base = _open(folder)
                fs.create_dir(base, recursive=True)
                path = f"{uuid.uuid4().hex}.warc.gz"
                sink = fs.open_output_stream(f"{base}/{path}", compression=None)
            rows = []
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in rb.columns)):
                payload = (html or "").encode("utf-8")
                digest = payload_digest(payload)
                packer = zlib.compressobj(1, wbits=31)
                data = packer.compress(record(page_id, url, payload, digest, len(payload), refers_to)) + packer.flush()
                sink.write(data)
                rows.append((page_id, path, at, len(data), url, digest, "response" if refers_to is None else "revisit"))
                at += len(data)
            if rows:
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=["page_id", "archive", "offset", "length", "url", "digest", "record_type"])
        if sink is not None:
            sink.close()
    return pages.select("page_id", "url", "html", "refers_to").mapInArrow(run, INDEX)


def _ranges(rows: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """(first row, last row + 1, from, to) of requests over sorted ranges."""
    first = 0
    for k in range(1, len(rows) + 1):
        if k == len(rows) or rows[k][0] > sum(rows[k - 1]) + GAP or sum(rows[k]) - rows[first][0] > REQUEST:
            yield first, k, rows[first][0], max(sum(r) for r in rows[first:k])
            first = k


def read_records(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records that ``index`` names, digests of responses taken anew from
    the bytes read; ``payload`` is null unless asked for (and for revisits)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        for rb in batches:
            archives, offsets, lengths = (c.to_pylist() for c in rb.columns[:3])
            out = []
            a = 0
            while a < len(archives):
                b = a
                while b < len(archives) and archives[b] == archives[a]:
                    b += 1
                with fs.open_input_file(f"{base}/{archives[a]}") as source:
                    for x, y, lo, hi in _ranges(list(zip(offsets[a:b], lengths[a:b]))):
                        data = source.read_at(hi - lo, lo)
                        for o, n in zip(offsets[a + x:a + y], lengths[a + x:a + y]):
                            out.append(_row(zlib.decompress(data[o - lo:o - lo + n], wbits=31), with_payload))
                a = b
            if out:
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                      names=[c.split(" ")[0] for c in RECORDS.split(", ")])

    rows = index.select("archive", "offset", "length", F.floor(F.col("offset") / STRIPE).alias("stripe"))
    stripes = rows.agg(F.count_distinct("archive", "stripe")).first()[0]  # a number that is given is not merged again
    return (rows.repartition(max(stripes, 1), "archive", "stripe").sortWithinPartitions("archive", "offset")
            .select("archive", "offset", "length").mapInArrow(run, RECORDS))


def _row(data: bytes, with_payload: bool) -> tuple:
    fields, http, payload = parse(data)
    kind = fields["WARC-Type"]

    def page(name):
        found = re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))
        return int(found[1]) if found else None

    digest = payload_digest(payload) if kind == "response" else fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = len(payload) if kind == "response" else int(http["Content-Length"])
    return (page("WARC-Record-ID"), size, digest, kind, page("WARC-Refers-To"), fields["WARC-Target-URI"],
            payload if with_payload and kind == "response" else None)


def with_first_copies(spark: SparkSession, pages: DataFrame, min_bytes: int, folder: str) -> DataFrame:
    """``pages`` (page_id, url, html) with ``refers_to``: the smallest page of
    an equal payload, null for that page itself and below ``min_bytes``.

    Payloads are told apart by SHA-1 and size. Only digests are grouped and
    joined by payload; the html moves once, by page."""
    body = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", F.sha1(F.encode(body, "UTF-8")).alias("sha"), F.octet_length(body).alias("size"))
    first = stored(keyed.where(F.col("size") >= min_bytes).groupBy("sha", "size")
                   .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
                   .select("sha", "size", "first"), f"{folder}/first")
    later = (keyed.join(first, ["sha", "size"]).where("first is not null and not (page_id <=> first)")
             .select(F.col("page_id").alias("r_page"), F.col("sha").alias("r_sha"), F.col("first").alias("refers_to")).distinct())
    rows = pages.withColumn("sha", F.sha1(F.encode(body, "UTF-8")))
    return (rows.join(later, F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("sha") == F.col("r_sha")), "left")
            .select("page_id", "url", "html", "refers_to"))


def archive_pages(spark: SparkSession, pages: DataFrame, min_bytes: int = 0, folder: str | None = None,
                  with_payload: bool = False) -> DataFrame:
    """Write one record per row of ``pages``, then read all records back.

    Null html is an empty payload, which counts as equal to other empty ones
    when ``min_bytes`` is 0. Rows that repeat a page_id with its payload are
    all responses if that page is the first of its payload. A null page_id
    never is a first page; a null url is an empty target. An empty table
    writes nothing and gives no rows; further columns are not read."""
    folder = folder or scratch_dir(spark, "warc")
    rows = with_first_copies(spark, pages.select("page_id", "url", "html"), min_bytes, folder)
    index = stored(write_archives(rows, f"{folder}/archives"), f"{folder}/index")
    return read_records(index, f"{folder}/archives", with_payload)

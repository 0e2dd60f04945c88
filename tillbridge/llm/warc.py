"""WARC archives: deduplicated writing, an index, and coalesced range reads.

``write`` makes one record per page, each a gzip member of its own, and an index row with the
record's file, offset, length, URL and payload digest. Of pages with equal payloads (of at
least ``least_bytes``) those with the largest id become response records and the others revisit
records that refer to it. ``read`` sorts selected index rows by file and offset, joins ranges
that are close to each other into one read, and parses the records.

Executors write and read the archives where ``folder`` says, through pyarrow's file systems;
pass ``opener`` for other stores. A task that runs again writes new files, and the index names
only those of the tasks that Spark committed.

Null payloads are empty ones. Rows that repeat an id with the same payload get the same record
type. A page without an id is a response only if no page with its payload has one. A missing
URL is left out of the record; line breaks in a URL are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbridge.llm.common import Scratch

FILE_BYTES = 1 << 28  # an archive is closed beyond this
GAP_BYTES = 1 << 16  # ranges no farther apart are read at once
READ_BYTES = 1 << 23  # but no more than this at once
TASK_BYTES = 1 << 25  # archive bytes a reading task gets
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "file string, `offset` long, length long, page_id long, url string, digest string, record_type string, refers_to long"
RECORDS = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
           "payload_digest string, payload binary")


def open_store(path: str):
    """A file system and the path there."""
    scheme, found, rest = path.partition("://")
    if not found:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + "://" + rest)


def qualified(spark, folder: str) -> str:
    """The folder with its scheme: one without names a place on Spark's default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
        if refers_to is not None:
            head.append(f"Refers-To-Page-Id: {refers_to}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse(data: bytes):
    """(headers, payload, its length) of a gzip member; a revisit's payload is empty."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    http, _, payload = rest[:int(headers["Content-Length"])].partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    if headers["WARC-Type"] == "response" and (
            len(payload) != size or "sha1:" + base32(hashlib.sha1(payload).digest()) != headers["WARC-Payload-Digest"]):
        raise ValueError(f"damaged payload of {headers['WARC-Record-ID']}")
    return headers, payload, size


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def write(pages: DataFrame, folder: str, id_column: str = "page_id", url: str = "url", html: str = "html",
          least_bytes: int = 0, level: int = 5, opener=open_store) -> DataFrame:
    """Archive all rows below ``folder`` and return the index, stored there as Parquet."""
    folder = qualified(pages.sparkSession, folder)
    text = F.coalesce(F.col(html).cast("string"), F.lit(""))
    source = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                          text.alias("html")).withColumn("digest", F.sha1("html"))
    key = F.concat_ws(":", "digest", "page_id").alias("key")
    known = source.where(F.octet_length("html") >= least_bytes).select("digest", "page_id").distinct()
    largest = known.groupBy("digest").agg(F.max("page_id").alias("refers_to"))
    others = (known.join(largest, "digest").where("NOT (page_id <=> refers_to)").select(key, "refers_to")
              .withColumn("revisit", F.lit(True)))
    rows = source.select("page_id", "url", "html", "digest", key).join(others, "key", "left").select(
        "page_id", "url", "html", "digest", "refers_to", F.coalesce("revisit", F.lit(False)).alias("revisit"))
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches):
        part, out, path, at = TaskContext.get().partitionId(), None, None, 0
        try:
            for batch in batches:
                found = []
                for page_id, link, payload, digest, refers_to, revisit in zip(
                        *(batch.column(c) for c in range(6))):
                    if out is None:
                        path = f"{folder}/{part:05d}-{uuid.uuid4().hex}.warc.gz"
                        store, inner = opener(path)
                        if isinstance(store, fs.LocalFileSystem):
                            os.makedirs(os.path.dirname(inner), exist_ok=True)
                        out, at = store.open_output_stream(inner, compression=None), 0
                    page_id, link, refers_to, revisit = page_id.as_py(), link.as_py(), refers_to.as_py(), revisit.as_py()
                    digest = base32(bytes.fromhex(digest.as_py()))
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    raw = record(page_id, link, payload.as_buffer().to_pybytes(), digest, refers_to, revisit, date)
                    data = packer.compress(raw) + packer.flush()
                    out.write(data)
                    found.append((path, at, len(data), page_id, link, digest,
                                  "revisit" if revisit else "response", refers_to))
                    at += len(data)
                    if at > FILE_BYTES:
                        out.close()
                        out = None
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*found), _INDEX_TYPES)], _INDEX_NAMES)
        finally:
            if out is not None:
                out.close()

    rows.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


_INDEX_NAMES = ["file", "offset", "length", "page_id", "url", "digest", "record_type", "refers_to"]
_INDEX_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]


def coalesced(files, offsets, lengths):
    """(file, first byte, end, number of records) of the reads for ranges in order."""
    reads = []
    for file, offset, length in zip(files, offsets, lengths):
        if reads and reads[-1][0] == file and offset - reads[-1][2] <= GAP_BYTES and offset + length - reads[-1][1] <= READ_BYTES:
            reads[-1][2] = max(reads[-1][2], offset + length)
            reads[-1][3] += 1
        else:
            reads.append([file, offset, offset + length, 1])
    return reads


def read(selected: DataFrame, opener=open_store) -> DataFrame:
    """The records of index rows: ids, type, and the payload (null for a revisit) with its size and digest."""
    total, rows = selected.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    parts = max(1, min(rows, max(-(-total // TASK_BYTES), selected.sparkSession.sparkContext.defaultParallelism)))
    ranges = (selected.select("file", "offset", "length").repartitionByRange(parts, "file", "offset")
              .sortWithinPartitions("file", "offset"))

    def run(batches):
        for batch in batches:
            files, offsets, lengths = (batch.column(c).to_pylist() for c in range(3))
            at, name, source = 0, None, None
            for file, begin, end, many in coalesced(files, offsets, lengths):
                if file != name:
                    store, inner = opener(file)
                    name, source = file, store.open_input_file(inner)
                data = source.read_at(end - begin, begin)
                found = []
                for offset, length in zip(offsets[at:at + many], lengths[at:at + many]):
                    headers, payload, size = parse(data[offset - begin:offset - begin + length])
                    page_id, refers_to = headers.get("Page-Id"), headers.get("Refers-To-Page-Id")
                    found.append((
                        page_id and int(page_id), headers.get("WARC-Target-URI"), headers["WARC-Type"],
                        refers_to and int(refers_to), size, headers["WARC-Payload-Digest"].removeprefix("sha1:"),
                        payload if headers["WARC-Type"] == "response" else None))
                at += many
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), _RECORD_TYPES)], _RECORD_NAMES)

    return ranges.mapInArrow(run, RECORDS)


_RECORD_NAMES = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
_RECORD_TYPES = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Archive all pages in a new folder of the shared store and read every record back."""
    return read(write(pages, Scratch(pages.sparkSession, "warc").folder("archive"), **options))

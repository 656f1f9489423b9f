"""WARC archives: one gzip member per record, written and read sequentially."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from drydock.llm.common import staged
from drydock.session import scratch

CRLF = b"\r\n"
READ_BYTES = 1 << 20
ROLL_BYTES = 256 << 20

RECORD_SCHEMA = """archive string, offset long, warc_type string, record_id string, target_uri string,
                   page_id long, refers_to long, payload_bytes long, payload_digest string,
                   payload binary, error string"""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    found = (name or "").strip("<>").rpartition(":")[2]
    return int(found) if found.lstrip("-").isdigit() else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, is_revisit: bool,
                 refers_to: int | None, date: str) -> bytes:
    """One record as one gzip member. A revisit carries the HTTP header alone."""
    http = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                      b"Content-Length: %d" % len(payload), b"", b""])
    block = http if is_revisit else http + payload
    fields = [("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", record_name(page_id)),
              ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{digest_of(block)}")]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.split())))
    if is_revisit:
        fields += [("WARC-Refers-To", record_name(refers_to)),
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + head + CRLF + block + CRLF + CRLF) + packer.flush()


# -- reading ------------------------------------------------------------------


def members(stream) -> Iterator[tuple[int, bytearray, str | None]]:
    """``(offset, content, error)`` of each gzip member, decompressed a block at a time."""
    waiting, offset = b"", 0
    while True:
        waiting = waiting or stream.read(READ_BYTES)
        if not waiting:
            return
        unpacker, content, used = zlib.decompressobj(31), bytearray(), 0
        while True:
            try:
                content += unpacker.decompress(waiting)
            except zlib.error as fault:
                yield offset, content, f"bad gzip member: {fault}"
                return  # where the next member starts cannot be known
            used += len(waiting) - len(unpacker.unused_data)
            waiting = unpacker.unused_data
            if unpacker.eof:
                break
            waiting = stream.read(READ_BYTES)
            if not waiting:
                yield offset, content, "archive ends inside a member"
                return
        yield offset, content, None
        offset += used


def parse_record(content: bytes) -> tuple[dict[str, str], bytes, str | None]:
    """Header fields (names in lower case), block, and what is wrong with the framing."""
    view = bytes(content)
    head, found, rest = view.partition(CRLF + CRLF)
    lines = head.split(CRLF)
    if not found or not lines[0].startswith(b"WARC/"):
        return {}, b"", "no WARC header"
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not length.isdigit():
        return fields, b"", "no Content-Length"
    n = int(length)
    if len(rest) != n + 4 or rest[n:] != CRLF + CRLF:
        return fields, rest[:n], f"Content-Length says {n}, the member holds {max(0, len(rest) - 4)}"
    return fields, rest[:n], None


def read_record(content: bytes) -> dict:
    fields, block, error = parse_record(content)
    claimed = fields.get("warc-block-digest")
    if error is None and claimed and claimed != f"sha1:{digest_of(block)}":
        error = "block digest differs"
    http, found, payload = block.partition(CRLF + CRLF)
    kind, stated = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha1:")
    size: int | None = len(payload)
    if kind == "revisit":
        lengths = [x.split(b":")[1].strip() for x in http.split(CRLF) if x.lower().startswith(b"content-length:")]
        size, payload = (int(lengths[0]) if lengths and lengths[0].isdigit() else None), None
    elif not found:
        size, payload, error = 0, b"", error or "no HTTP header"
    elif error is None and stated and digest_of(payload) != stated:
        error = "payload digest differs"
    return {"warc_type": kind, "record_id": fields.get("warc-record-id"),
            "target_uri": fields.get("warc-target-uri"), "page_id": page_of(fields.get("warc-record-id")),
            "refers_to": page_of(fields.get("warc-refers-to")) if kind == "revisit" else None,
            "payload_bytes": size, "payload_digest": stated or None, "payload": payload, "error": error}


def _open(uri: str):
    system, inner = pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
    return system, inner


def _reader(with_payload: bool):
    names = [part.split()[0] for part in RECORD_SCHEMA.split(",")]
    types = {"offset": pa.int64(), "page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(),
             "payload": pa.binary()}
    schema = pa.schema([(n, types.get(n, pa.string())) for n in names if with_payload or n != "payload"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inner = _open(path)
                rows, held = [], 0
                with system.open_input_stream(inner, compression=None) as stream:
                    for offset, content, error in members(stream):
                        row = read_record(content) if error is None else {"error": error}
                        if not with_payload:
                            row.pop("payload", None)
                        rows.append({n: None for n in schema.names} | row | {"archive": path, "offset": offset})
                        held += len(content) if with_payload else 200
                        if held > READ_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return read


def read_archives(archives: DataFrame, path: str = "path", payload: bool = True) -> DataFrame:
    """Every record of the archives named in ``path``, one archive per task at a time.

    A member is decompressed block by block, cut by its Content-Length, and its
    block and payload digests are computed anew; what does not fit is told in
    ``error`` and the rest of the row holds what could be read. A revisit has
    its payload's length from its HTTP header and no payload. File-system
    faults are raised, so Spark retries the task. The archives lie where the
    scheme of their URI is known to Arrow (file, hdfs, s3, gs).
    """
    schema = RECORD_SCHEMA if payload else RECORD_SCHEMA.replace("payload binary,", "")
    return archives.select(path).mapInArrow(_reader(payload), schema)


# -- writing ------------------------------------------------------------------


def _writer(folder: str, date: str, roll: int):
    schema = pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner = _open(folder)
        system.create_dir(inner, recursive=True)
        out, name, records, size, done = None, "", 0, 0, []

        def close():
            out.close()
            done.append({"path": f"{folder}/{name}", "n_records": records, "n_bytes": size})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:  # a name of its own for every attempt: one that was lost leaves nothing that is read
                    name, records, size = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{inner}/{name}", compression=None)
                payload = row["payload"] or b""
                member = record_bytes(row["page_id"], row["url"], payload, digest_of(payload), row["is_revisit"],
                                      row["refers_to"], date)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= roll:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pylist(done, schema=schema)
    return write


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                 least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, is_revisit, refers_to``: what each page's record will be.

    Of the pages with equal payloads (by SHA-256) of at least ``least_bytes``
    bytes the one with the largest id is the response, and the others revisit
    it. Only digests are grouped, combined before the shuffle; a payload which
    a third of all pages share is one row of the smaller side of the join.
    """
    own = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                       F.coalesce(F.col(html).cast("string").cast("binary"), F.lit(b"")).alias("payload"))
    keyed = own.withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= least_bytes
    shared = (keyed.filter(large).groupBy("digest").agg(F.max("page_id").alias("winner"), F.count("*").alias("n"))
              .filter("n > 1").select(F.col("digest").alias("shared"), "winner"))
    joined = keyed.join(shared, (F.col("digest") == F.col("shared")) & large, "left")
    revisit = F.col("shared").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner"))
    return joined.select("page_id", "url", "payload", revisit.alias("is_revisit"),
                         F.when(revisit, F.col("winner")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", roll: int = ROLL_BYTES) -> DataFrame:
    """Write a record per row; gives the list ``(path, n_records, n_bytes)`` of archives.

    Each task writes archives of its own and a new one after ``roll`` bytes. Only
    archives in the list count, and the list is committed by Spark: a task that
    was lost or ran twice leaves a file that nothing names.

    A null html is an empty payload, a null url leaves the field out, a null id
    gives a record without a page. Rows that repeat the largest id of equal
    payloads are all responses. An empty table gives no archive. Columns of
    other names are left aside.
    """
    planned = plan_records(pages, page_id, url, html, least_bytes)
    return staged(planned.mapInArrow(_writer(folder, date, roll), "path string, n_records long, n_bytes long"),
                  "warc-list")


def round_trip(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """Write the pages' archives into the shared scratch folder and read every record back (no payloads)."""
    archives = write_archives(pages, scratch(spark, "warc"), **options)
    many = spark.sparkContext.defaultParallelism
    return read_archives(archives.repartition(max(many, int(spark.conf.get("spark.sql.shuffle.partitions")))),
                         payload=False)

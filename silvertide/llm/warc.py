"""WARC archives: one gzip member per record, written by tasks, read back by byte ranges.

A reading task owns the records whose member starts inside its range. It looks for the gzip magic there, accepts a place
only if the member decodes to a WARC header, and reads on past the end of its range to finish its last record.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silvertide.llm.shared import new_path

#: Payloads from this size on are stored once.
LEAST_SHARED = 100
#: Most tasks that read ranges; beyond that a task reads several.
READ_TASKS = 20_000
SPLIT_BYTES = 8 << 20
#: Members are looked for in pieces of this size.
SCAN_BYTES = 1 << 20
#: How much of a candidate is decoded to see whether a WARC header begins it.
PROBE_BYTES = 4096
MAGIC = b"\x1f\x8b\x08"


def _open(path: str, mode: str) -> BinaryIO:
    """A file by URI: local and mounted ones directly, any other store through Arrow."""
    scheme, found, rest = path.partition(":")
    if not found or scheme == "file":
        return open(re.sub(r"^file:/*", "/", path), mode)  # noqa: SIM115
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_output_stream(inner) if "w" in mode else store.open_input_file(inner)


def _local(path: str) -> str | None:
    return re.sub(r"^file:/*", "/", path) if ":" not in path or path.startswith("file:") else None


def _finish(written: str, path: str) -> None:
    """Renames a whole file to its name; a second attempt replaces it by the same content."""
    if (local := _local(written)) is not None:
        os.replace(local, _local(path))
        return
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(written)
    store.move(inner, fs.FileSystem.from_uri(path)[1])


def record(kind: str, page: str, target: str, digest: str, size: int, payload: bytes, refers_to: str | None) -> bytes:
    """One record as a gzip member. A revisit holds the HTTP head only, with the length of the full payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + (payload if kind == "response" else b"")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page}>", "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    plain = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(plain) + packer.flush()


def classified(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """pages with payload_bytes, payload_digest, record_type and refers_to.

    Of equal payloads of at least that size, the row with the smallest page_id is the response; rows that repeat this
    page_id are responses too. Null html is an empty payload, and null ids come after all others.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    known = pages.select("page_id", "url", "html", F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest"))
    large = F.col("payload_bytes") >= least
    first = known.where(large).groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    repeated = large & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    joined = known.join(first.drop("copies"), "payload_digest", "left")
    return joined.withColumns({
        "record_type": F.when(repeated, "revisit").otherwise("response"), "refers_to": F.when(repeated, F.col("first_id")),
    }).drop("first_id")


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes classified pages below folder and returns the (path, bytes, records) of the files, stored.

    A task writes one file under a name of its attempt and renames it when it is whole.
    """
    spark = records.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(conf).mkdirs(where)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        path = f"{folder}/part-{context.partitionId():06d}.warc.gz"
        draft = f"{path}.{context.taskAttemptId()}.open"
        size = n = 0
        sink = None
        for batch in batches:
            columns = [batch.column(c) for c in ("record_type", "page_id", "url", "payload_digest", "payload_bytes", "html", "refers_to")]
            for i in range(batch.num_rows):
                kind, page, url, digest, length, html, refers = (c[i].as_py() for c in columns)
                member = record(kind, "" if page is None else str(page), re.sub(r"\s", "%20", url or ""), digest, length, (html or "").encode(), None if refers is None else str(refers))
                sink = sink or _open(draft, "wb")
                sink.write(member)
                size, n = size + len(member), n + 1
        if sink:
            sink.close()
            _finish(draft, path)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size]), pa.array([n])], ["path", "bytes", "records"])

    listing = new_path(spark, "warc-files")
    records.mapInArrow(run, "path string, bytes long, records long").write.parquet(listing)
    return spark.read.schema("path string, bytes long, records long").parquet(listing)


def members(source: BinaryIO, size: int, start: int, end: int) -> Iterator[bytes]:
    """The decoded records whose gzip member starts in [start, end), in order.

    The magic may also occur inside a member. A place counts only if the bytes from there decode to a WARC header; after
    a record the search goes on behind its member.
    """
    at = start
    while at < end:
        source.seek(at)
        piece = source.read(min(SCAN_BYTES, end - at) + len(MAGIC) - 1)
        found = piece.find(MAGIC)
        if found < 0 or at + found >= end:
            at += max(len(piece) - len(MAGIC) + 1, 1)
            continue
        at += found
        whole = _member(source, at)
        if whole is None:
            at += 1
        else:
            plain, length = whole
            yield plain
            at += length


def _member(source: BinaryIO, at: int) -> tuple[bytes, int] | None:
    """The decoded member at a place and its length in the file, or None if no record starts there."""
    source.seek(at)
    unpacker, out, read, step = zlib.decompressobj(31), [], 0, PROBE_BYTES
    checked = False
    try:
        while not unpacker.eof:
            piece = source.read(step)
            if not piece:
                return None
            read += len(piece)
            out.append(unpacker.decompress(piece))
            if not checked and sum(map(len, out)) >= 5:
                if not b"".join(out).startswith(b"WARC/"):
                    return None
                checked = True
            step = min(step * 2, SCAN_BYTES)
    except zlib.error:
        return None
    return (b"".join(out), read - len(unpacker.unused_data)) if checked else None


def parse(plain: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a record; names in lower case."""
    head, _, rest = plain.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
    block = rest[: int(fields["content-length"])]
    web, _, payload = block.partition(b"\r\n\r\n")
    http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in web.decode().split("\r\n")[1:])}
    return fields, http, payload


def read_archives(spark: SparkSession, files: DataFrame, id_type: str = "bigint", split_bytes: int = SPLIT_BYTES, with_payload: bool = False) -> DataFrame:
    """One row per record in the files (path, bytes), read by byte ranges that do not depend on record boundaries.

    page_id, url, payload_bytes, payload_digest, record_type, refers_to, and the payload if asked for. The digest of a
    response is computed from what was read and must equal the stored one; a revisit carries those of the full payload.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long")))
    ranges = files.select("path", "bytes", starts.alias("start"))
    # A stated number of partitions is not merged; the rows of one partition are dealt out in turns.
    tasks = max(1, min(ranges.count(), READ_TASKS))
    ranges = ranges.coalesce(1).repartition(tasks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page", "url", "payload_bytes", "payload_digest", "record_type", "refers"] + ["payload"] * with_payload
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()] + [pa.binary()] * with_payload

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        rows, held = [], 0
        for batch in batches:
            for part in batch.to_pylist():
                with _open(part["path"], "rb") as source:
                    for plain in members(source, part["bytes"], part["start"], min(part["start"] + split_bytes, part["bytes"])):
                        fields, http, payload = parse(plain)
                        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
                        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{part['path']}: a payload differs from its digest")
                        size = len(payload) if kind == "response" else int(http["content-length"])
                        page, refers = (fields.get(k, "")[len("<urn:page:") : -1] or None for k in ("warc-record-id", "warc-refers-to"))
                        rows.append((page, fields["warc-target-uri"], size, digest, kind, refers, *[payload] * with_payload))
                        held += len(payload) if with_payload else 200
                        if held > SCAN_BYTES:
                            yield packed(rows)
                            rows, held = [], 0
        if rows:
            yield packed(rows)

    schema = "page string, url string, payload_bytes long, payload_digest string, record_type string, refers string" + ", payload binary" * with_payload
    found = ranges.mapInArrow(run, schema)
    names = ["url", "payload_bytes", "payload_digest", "record_type"]
    return found.select(F.col("page").cast(id_type).alias("page_id"), *names, F.col("refers").cast(id_type).alias("refers_to"), *["payload"] * with_payload)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes pages as archives, below folder or in the shared folder, and reads them back: one row per page.

    Null html is an empty payload, a null url an empty one; white space in urls is escaped. Empty tables give no rows.
    """
    spark = pages.sparkSession
    files = write_archives(classified(pages), folder or new_path(spark, "warc"))
    return read_archives(spark, files, pages.schema["page_id"].dataType.simpleString())

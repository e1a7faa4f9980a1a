"""WARC archives: written one gzip member per record, read back sequentially.

Equal payloads are found by digest with a partial aggregation. The leads of the most common payloads (at most a
thousand) are broadcast, so their rows, and those too short for a revisit, stay where they are; only the other rows
are joined by digest. All go to archive files of bounded size in the folder all executors share. Every attempt of a task writes
files of its own, and only those that a finished task reports are read, so lost executors leave no half archives.
"""

from __future__ import annotations

import datetime
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import join_hot, new_folder, staged

#: Payloads of fewer bytes are never written as revisits.
REVISIT_BYTES = 100
#: An archive is closed once it has so many bytes.
ARCHIVE_BYTES = 64 << 20
_READ_BYTES = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes bigint, payload binary, verified boolean"


def record_uri(value: object) -> str:
    """The record id of a page key; null keys share one."""
    return f"<urn:page:{'null' if value is None else value}>"


def warc_record(page: object, url: str | None, payload: bytes, refers_to: object, revisit: bool, date: str) -> bytes:
    """One gzip member: WARC headers, then an HTTP head, then for responses the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_uri(page)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_uri(refers_to)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def plan_records(pages: DataFrame, key: str, url: str, payload: str, least: int = REVISIT_BYTES) -> DataFrame:
    """``key``, ``url``, payload and refers_to: the smallest key with the same payload, null for responses.

    Null payloads are empty. Rows that share both the smallest key and the payload are all responses; with
    only null keys for a payload all are responses too, while null keys beside others revisit them.
    """
    rows = pages.select(F.col(key).alias("page"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("body"))
    rows = rows.withColumn("digest", F.when(F.octet_length("body") >= least, F.sha2(F.col("body"), 256)))
    first = rows.where("digest is not null").groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n"))
    first = staged(first.where("n > 1 and first is not null"), "payloads")
    joined = join_hot(rows, first, "digest", "n", pages.count())
    return joined.select("page", "url", "body", F.when(~F.col("first").eqNullSafe(F.col("page")), F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = REVISIT_BYTES, date: str | None = None, most: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives below ``folder`` and return their paths: one row of path and records for each file."""
    stamp = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, path, size, n, paths, counts = None, "", 0, 0, [], []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if out is None:
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    out, size, n = store.open_output_stream(path, compression=None), 0, 0
                page, link, body, refers_to = row
                data = warc_record(page, link, body.encode(), refers_to, refers_to is not None, stamp)
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= most:
                    out.close()
                    paths.append(path)
                    counts.append(n)
                    out = None
        if out is not None:
            out.close()
            paths.append(path)
            counts.append(n)
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], names=["path", "records"])

    return staged(plan_records(pages, key, url, payload, least).mapInArrow(write, "path string, records bigint"), "archives")


class Members:
    """Records of one archive in order: inflates a member at a time and frames its block by content length."""

    def __init__(self, stream):
        self.stream, self.rest, self.at = stream, b"", 0

    def member(self) -> bytes | None:
        """The next gzip member, inflated, or None after the last one."""
        if not self.rest:
            self.rest = self.stream.read(_READ_BYTES)
        if not self.rest:
            return None
        inflater, parts = zlib.decompressobj(31), []
        while not inflater.eof:
            if not self.rest:
                self.rest = self.stream.read(_READ_BYTES)
                if not self.rest:
                    raise ValueError(f"record {self.at}: the archive ends inside a gzip member")
            parts.append(inflater.decompress(self.rest))
            self.rest = inflater.unused_data
        return b"".join(parts)

    def __iter__(self) -> Iterator[tuple]:
        while (data := self.member()) is not None:
            yield read_record(data, self.at)
            self.at += 1


def read_record(data: bytes, at: int) -> tuple:
    """The columns of RECORDS of one inflated member; anything out of frame raises, a wrong digest is told."""
    head, found, body = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError(f"record {at}: no WARC header")
    field = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(field["content-length"])
    block = body[:length]
    if len(block) != length or body[length:] != b"\r\n\r\n":
        raise ValueError(f"record {at}: the block doesn't have its content length")
    http, _, payload = block.partition(b"\r\n\r\n")
    told = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}
    kind, digest = field["warc-type"], field["warc-payload-digest"].removeprefix("sha256:")
    sound = hashlib.sha256(block).hexdigest() == field["warc-block-digest"].removeprefix("sha256:")
    if kind == "response":
        sound = sound and hashlib.sha256(payload).hexdigest() == digest and len(payload) == int(told["content-length"])
    return (field["warc-record-id"], kind, field.get("warc-target-uri"), field.get("warc-refers-to"), digest, int(told["content-length"]), payload if kind == "response" else None, sound)


def read_archives(paths: DataFrame, path: str = "path", partitions: int | None = None) -> DataFrame:
    """The records of the archives whose paths the rows hold; each archive is read by one task, front to back."""
    uri = paths.select(F.col(path).alias("path"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.bool_()]
        names = [x.split()[0] for x in RECORDS.split(", ")]

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, inner = fs.FileSystem.from_uri(name) if "://" in name else (fs.LocalFileSystem(), name)
                with store.open_input_stream(inner, compression=None) as stream:
                    rows, held = [], 0
                    for row in Members(stream):
                        rows.append(row)
                        held += len(row[6] or b"") + 500
                        if held > (4 << 20):
                            yield table(rows)
                            rows, held = [], 0
                    if rows:
                        yield table(rows)

    return uri.repartition(partitions or paths.sparkSession.sparkContext.defaultParallelism, F.hash("path")).mapInArrow(read, RECORDS)


def archive_round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write ``pages`` as archives in the shared folder, then read every record back (columns of RECORDS)."""
    return read_archives(write_archives(pages, new_folder(pages.sparkSession, "warc"), key, url, payload))

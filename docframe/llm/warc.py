"""WARC archives as seekable Zstandard bundles (operator 9).

Records are grouped into independent Zstandard frames; a skippable frame at the end of an archive holds the
seek table (compressed and plain size of every frame, count, descriptor, magic number 0x8F92EAB1). The
manifest maps each record to its archive, frame and offset in the frame, so one record is read by one seek.

Of records with equal payloads of at least 100 bytes the one with the smallest page_id is a response and the
others are revisits that refer to it; payloads meet their digest's smallest page_id in 64 places for each
digest. Archives lie in the shared folder; a task writes under a name of its own attempt, and only archives
that the manifest lists count, so a repeated task does no harm. Defined results: null html is the empty
payload; rows that repeat the smallest page_id are each a response; null page_ids come after all others; an
empty table gives no archive; records of any length are whole (a frame holds one record at least).
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.llm._io import cut, fresh_path, with_group_stats
from docframe.llm._words import slices

_SPACE = uuid.UUID("8f0a1d5e-0c5b-4c55-9d1c-2f5f5f0e9a11")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NULL_ID = (1 << 63) - 1
SKIPPABLE, FOOTER_MAGIC = 0x184D2A5E, 0x8F92EAB1


def record_uri(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, str(page_id))}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record, a revisit where refers_to is given."""
    revisit = refers_to is not None
    target = quote(url, safe=":/?#[]@!$&'()*+,;=%~") if url else f"urn:page:{page_id}"
    body = b"" if revisit else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_uri(page_id)}", f"WARC-Target-URI: {target}", f"WARC-Date: {date}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}", f"X-Page-Id: {'' if page_id is None else page_id}"]
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_uri(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_records(data: bytes):
    """(start, headers, body) of every record in a plain frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = data[at:end].decode().split("\r\n")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head[1:])
        size = int(headers["Content-Length"])
        yield at, headers, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


class BundleWriter:
    """Frames into one archive; close() appends the seek table."""

    def __init__(self, stream, frame_bytes: int, level: int = 3):
        import zstandard

        self.stream, self.frame_bytes, self.packer = stream, frame_bytes, zstandard.ZstdCompressor(level=level)
        self.plain, self.frames, self.at = io.BytesIO(), [], 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        """(frame, offset in the plain frame, length)."""
        if self.plain.tell() and self.plain.tell() + len(record) > self.frame_bytes:
            self.flush()
        place = (len(self.frames), self.plain.tell(), len(record))
        self.plain.write(record)
        return place

    def flush(self) -> None:
        if self.plain.tell():
            packed = self.packer.compress(self.plain.getvalue())
            self.stream.write(packed)
            self.frames.append((len(packed), self.plain.tell()))
            self.at += len(packed)
            self.plain = io.BytesIO()

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, FOOTER_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.stream.close()


class BundleReader:
    """Random access by frame through the seek table."""

    def __init__(self, stream):
        import zstandard

        self.stream, self.unpacker = stream, zstandard.ZstdDecompressor()
        size = stream.size()
        stream.seek(size - 9)
        count, _, magic = struct.unpack("<IBI", stream.read(9))
        if magic != FOOTER_MAGIC:
            raise ValueError("no seek table")
        stream.seek(size - 9 - 8 * count)
        sizes = list(struct.iter_unpack("<II", stream.read(8 * count)))
        self.frames, at = [], 0
        for packed, plain in sizes:
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, i: int) -> bytes:
        at, packed, plain = self.frames[i]
        self.stream.seek(at)
        return self.unpacker.decompress(self.stream.read(packed), max_output_size=max(plain, 1))

    def record(self, frame: int, offset: int, length: int) -> bytes:
        return self.frame(frame)[offset : offset + length]


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder. Archives are written by Python, which knows file, hdfs, s3, gs and abfss
    addresses (s3a and s3n as s3); for any other kind this raises, on the driver, before a page is read."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", folder))


def classify(pages: DataFrame, least: int = 100) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null: a response) of every row."""
    rows = pages.select(
        F.coalesce(F.col("page_id").cast("long"), F.lit(_NULL_ID)).alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("string").alias("payload"),
    ).withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    met = with_group_stats(rows, "digest", F.col("page_id"), F.min("page_id").alias("first_id"))
    repeats = (F.octet_length("payload") >= least) & (F.col("page_id") != F.col("first_id"))
    return met.select("page_id", "url", "payload", "digest", F.when(repeats, F.col("first_id")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, frame_bytes: int = 1 << 18, archive_bytes: int = 1 << 26, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write every page into archives under folder; returns the manifest, itself a written table."""

    def run(batches):
        store, root = store_of(folder)
        context = TaskContext.get()
        own = f"{context.partitionId():06d}-{context.taskAttemptId()}" if context else "0-0"
        store.create_dir(root, recursive=True)
        writer, name, number = None, "", 0
        for batch in slices(batches, "payload"):
            out = []
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    name = f"{root}/pages-{own}-{number:04d}.warc.zst"
                    writer, number = BundleWriter(store.open_output_stream(name, compression=None), frame_bytes), number + 1
                page_id = None if page_id == _NULL_ID else page_id
                place = writer.add(make_record(page_id, url, payload.encode(), digest, refers_to, date))
                out.append((page_id, name, *place))
                if writer.at >= archive_bytes:
                    writer.close()
                    writer = None
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["page_id", "archive", "frame", "offset", "length"])
        if writer is not None:
            writer.close()

    store_of(folder)
    schema = "page_id long, archive string, frame int, offset long, length long"
    return cut(classify(pages).mapInArrow(run, schema), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the manifest's archives, read frame by frame: page_id, payload_bytes, payload_digest,
    record_type, refers_to, url, payload (null for revisits). A response's digest and length are taken from the
    payload that was read and must agree with its headers."""

    def run(batches):
        store, _ = store_of(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_file(name) as stream:
                    reader = BundleReader(stream)
                    for i in range(len(reader.frames)):
                        out = []
                        for _, headers, body in parse_records(reader.frame(i)):
                            page = int(headers["X-Page-Id"]) if headers["X-Page-Id"] else None
                            size, digest = int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha256:")
                            kind, payload, refers = headers["WARC-Type"], None, None
                            if kind == "response":
                                payload = body[body.index(b"\r\n\r\n") + 4 :]
                                if (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
                                    raise ValueError(f"{name}: record {page} is damaged")
                            else:
                                refers = int(headers["X-Refers-To-Page"])
                            out.append((page, size, digest, kind, refers, headers["WARC-Target-URI"], None if payload is None else payload.decode()))
                        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], NAMES)

    archives = manifest.select("archive").distinct()
    # A stated number of partitions, one archive each: adaptive execution would merge them by the bytes of their names.
    return archives.repartition(max(1, archives.count())).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload string")


NAMES = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write pages into archives and read them back."""
    folder = folder or fresh_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)

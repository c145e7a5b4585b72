"""Seekable Zstandard WARC bundles.

*Writing.* Each task writes its records into bundles of at most about
``BUNDLE_BYTES``. A bundle is a sequence of independent Zstandard frames of
about ``FRAME_BYTES`` of whole records each, followed by a seek table in a
skippable frame (the published seekable format: per frame its compressed and
plain size, then the number of frames, a descriptor byte and a magic number).
A manifest row per record maps its identifier to bundle, frame and offset
inside the frame. Manifest rows of a task only count once the task has
succeeded, and every attempt writes files with names of its own, so a retried
or speculative task leaves at most files that no row names.

*Duplicates.* Payloads of at least ``REVISIT_BYTES`` that are equal (by SHA-1
and length) keep one response: the record with the largest key. The others are
revisits: their HTTP header still has the payload's length, the WARC header its
digest and the identifier of the record it refers to. Only digests that occur
more than once are joined back, and their largest key comes from a partially
aggregated group, so a page that makes up a third of the table is no hot task.

*Reading.* Any frame can be read by itself: seek tables are read first, then
frame ranges are dealt over the tasks. Single records are read by their
manifest row. Files are opened through ``pyarrow.fs``, so the folder may be on
any shared store that it knows.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaflow.llm.common import bounded_batches, cut
from voltaflow.session import scratch_dir

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 128 << 20
REVISIT_BYTES = 1000
#: Plain bytes of the frames that one reading task takes at once.
READ_BYTES = 32 << 20
#: Bundles whose seek tables one task reads.
OPENED = 8
LEVEL = 3
# Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC, DESCRIPTOR = 0x184D2A5E, 0x8F92EAB1, 0
# Fixed values of the WARC format.
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "record_id string, bundle string, frame int, offset long, length long"


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    if not urlparse(folder).scheme:
        folder = f"file://{folder}"
    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder[5:]
    return pafs.FileSystem.from_uri(folder)


def _one_line(value: object) -> str:
    return re.sub(r"[\r\n]+", " ", str(value))


def record(record_id: str, uri: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A response record, or a revisit if it refers to another record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (b"" if refers_to else payload)
    head = [WARC_VERSION, f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {_one_line(uri)}")
    if refers_to:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """Records of a plain frame: header (names in lower case), block, offset."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if lines[0] != WARC_VERSION:
            raise ValueError(f"no record at offset {at}")
        head = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
        begin, size = end + 4, int(head["content-length"])
        yield head, data[begin:begin + size], at
        at = begin + size + 4


def payload_of(block: bytes) -> tuple[dict[str, str], bytes]:
    end = block.index(b"\r\n\r\n")
    lines = block[:end].decode().split("\r\n")
    return {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}, block[end + 4:]


class BundleWriter:
    """One bundle file; ``add`` gives the place of each record."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.path, self.stream = path, fs.open_output_stream(path, compression=None)
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.buffer, self.size, self.written = [], 0, 0

    def add(self, data: bytes) -> tuple[int, int]:
        if self.size and self.size + len(data) > FRAME_BYTES:
            self._flush()
        place = len(self.frames), self.size
        self.buffer.append(data)
        self.size += len(data)
        return place

    def _flush(self) -> None:
        frame = self.zstd.compress(b"".join(self.buffer))
        self.stream.write(frame)
        self.frames.append((len(frame), self.size))
        self.written += len(frame)
        self.buffer, self.size = [], 0

    def close(self) -> None:
        if self.size:
            self._flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), DESCRIPTOR, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.stream.close()


def seek_table(file) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame of an open bundle."""
    total = file.size()
    file.seek(total - 9)
    count, descriptor, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    width = 12 if descriptor & 0x80 else 8
    file.seek(total - 9 - width * count)
    raw, out, at = file.read(width * count), [], 0
    for k in range(count):
        packed, plain = struct.unpack_from("<II", raw, k * width)
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(file, place: tuple[int, int, int]) -> bytes:
    file.seek(place[0])
    return zstandard.ZstdDecompressor().decompress(file.read(place[1]), max_output_size=place[2])


def write(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``rows(record_id, uri, payload, digest, refers_to)`` as bundles
    under ``folder``; returns the manifest, checkpointed. Rows without a
    ``record_id`` aren't expected; a null payload is written as an empty one."""
    bounded_batches()

    def bundles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = _store(folder)
        fs.create_dir(path, recursive=True)
        writer, places = None, []

        def done() -> pd.DataFrame:
            writer.close()
            return pd.DataFrame(places, columns=["record_id", "bundle", "frame", "offset", "length"])
        for part in batches:
            for rid, uri, payload, digest, refers_to in part.itertuples(index=False, name=None):
                if writer is None:
                    writer, places = BundleWriter(fs, f"{path}/{uuid.uuid4().hex}.warc.zst"), []
                data = record(rid, uri, payload or b"", digest, refers_to)
                places.append((rid, writer.path.rpartition("/")[2], *writer.add(data), len(data)))
                if writer.written >= BUNDLE_BYTES:
                    yield done()
                    writer = None
        if writer is not None:
            yield done()
    return cut(rows.select("record_id", "uri", "payload", "digest", "refers_to").mapInPandas(bundles, MANIFEST))


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the bundles that the manifest names: ``record_id``,
    ``record_type``, ``uri``, ``payload_bytes`` and ``payload_digest`` (of the
    full payload, also for revisits), ``refers_to`` (record id) and ``payload``
    (null for revisits). A payload whose digest differs from its header is an error."""
    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = _store(folder)
        for part in batches:
            for name in part["bundle"]:
                with fs.open_input_file(f"{path}/{name}") as f:
                    first, size, table = 0, 0, seek_table(f)
                    out = []
                    for k, (_, _, plain) in enumerate(table):
                        if size and size + plain > READ_BYTES:
                            out.append((name, first, k))
                            first, size = k, 0
                        size += plain
                    out.append((name, first, len(table)))
                yield pd.DataFrame(out, columns=["bundle", "first", "last"])

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = _store(folder)
        for part in batches:
            for name, first, last in part.itertuples(index=False, name=None):
                with fs.open_input_file(f"{path}/{name}") as f:
                    table = seek_table(f)
                    for k in range(first, last):
                        yield pd.DataFrame([_row(h, b) for h, b, _ in parse(read_frame(f, table[k]))], columns=_COLUMNS)

    # explicit numbers of partitions: these rows are a few bytes each, so they would be merged into one task
    size = manifest.agg(F.sum("length").alias("plain"), F.countDistinct("bundle").alias("bundles")).first()
    tasks = max(1, -(-(size["plain"] or 0) // READ_BYTES), size["bundles"])
    names = manifest.select("bundle").distinct().repartition(max(1, -(-size["bundles"] // OPENED)), "bundle")
    parts = names.mapInPandas(ranges, "bundle string, first int, last int").repartition(tasks, "bundle", "first")
    return parts.mapInPandas(records, "record_id string, record_type string, uri string, payload_bytes long, "
                                      "payload_digest string, refers_to string, payload binary")


_COLUMNS = ["record_id", "record_type", "uri", "payload_bytes", "payload_digest", "refers_to", "payload"]


def _row(head: dict[str, str], block: bytes) -> tuple:
    http, payload = payload_of(block)
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    kind = head["warc-type"]
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"digest of {head['warc-record-id']} does not match")
    bare = lambda v: None if v is None else v[1:-1]
    return (bare(head["warc-record-id"]), kind, head.get("warc-target-uri"), int(http["content-length"]), digest,
            bare(head.get("warc-refers-to")), payload if kind == "response" else None)


def fetch(place, folder: str) -> tuple[dict[str, str], bytes]:
    """Header and block of one record, by its manifest row: reads one frame."""
    fs, path = _store(folder)
    with fs.open_input_file(f"{path}/{place['bundle']}") as f:
        data = read_frame(f, seek_table(f)[place["frame"]])
    head, block, _ = next(parse(data[place["offset"]:place["offset"] + place["length"]]))
    return head, block


def archive(pages: DataFrame, folder: str | None = None, key_col: str = "page_id", uri_col: str = "url",
            html_col: str = "html", revisit_bytes: int = REVISIT_BYTES) -> tuple[DataFrame, str]:
    """Write a record for each page; returns (manifest, folder).

    The payload is the html in UTF-8; a null html is an empty payload. Of equal
    payloads of at least ``revisit_bytes``, the one with the largest key is the
    response; if several rows share that key, each of them is a response. A null
    key counts as smaller than any other. Identifiers are ``urn:page:<key>``;
    rows that share a key share their identifier. Other columns are not read.
    """
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key_col).alias("key"), F.col(uri_col).alias("uri"), payload.alias("payload"),
                        F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size"))
    often = (rows.where(F.col("size") >= revisit_bytes).groupBy("digest", "size")
             .agg(F.count(F.lit(1)).alias("n"), F.max("key").alias("largest")).where("n > 1").drop("n"))
    named = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("null")))
    marked = rows.join(often.withColumn("known", F.lit(True)), ["digest", "size"], "left")
    revisit = F.col("known").isNotNull() & ~F.col("key").eqNullSafe(F.col("largest"))
    return write(marked.select(named(F.col("key")).alias("record_id"), "uri", "payload", "digest",
                               F.when(revisit, named(F.col("largest"))).alias("refers_to")), folder), folder


def key_of(record_id):
    """The key in an identifier (a long; null for a null key)."""
    return F.expr(f"try_cast(substring({record_id}, {len('urn:page:') + 1}) as bigint)")

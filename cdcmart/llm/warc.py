"""WARC archives in seekable Zstandard bundles.

``write_bundles`` writes one WARC record per row: a response with the payload,
or a revisit of the response with the smallest id and an equal payload. The
records of a bundle lie in groups, each a Zstandard frame of its own; a seek
table in a skippable frame at the bundle's end lists the frames. The index
maps every record to its bundle, frame and place in the frame, so any record
is read by one seek and one frame.

Bundles are files in a folder that all machines share, each with a name of its
own per task attempt. Only the bundles in the index count; a lost executor's
half-written bundle is in none.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_table

FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 32 << 20
#: payloads from this size on are stored once
LEAST_REVISIT = 100
# fixed values of the seekable format: skippable frame with the table, and its footer
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_DATE = "1970-01-01T00:00:00Z"  # the table has no time; a constant keeps bundles reproducible

INDEX_SCHEMA = "page_id long, bundle string, frame int, start long, size long"


def file_system(uri: str):
    """The file system and path of a folder that Spark names by a URI."""
    from pyarrow import fs
    scheme, rest = re.fullmatch(r"(?:([a-z0-9]+):)?(.*)", uri, re.S | re.I).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(("s3" if scheme in ("s3a", "s3n") else scheme) + ":" + rest)


def make_folder(folder: str) -> None:
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One record; a revisit (``refers_to``) has no body but names its payload's size."""
    name = "none" if page_id is None else str(page_id)
    head = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
            f"WARC-Record-ID: <urn:page:{name}>".encode(), f"WARC-Date: {_DATE}".encode(),
            b"WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url or "").encode(),
            f"WARC-Payload-Digest: sha256:{digest}".encode(), f"X-Payload-Length: {size}".encode()]
    if refers_to is not None:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>".encode()]
    body = payload if refers_to is None else b""
    head += [b"Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}".encode()]
    return b"\r\n".join(head) + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and body."""
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    size = int(fields["content-length"])
    return fields, raw[end + 4:end + 4 + size]


class BundleWriter:
    """Writes one bundle, frame by frame."""

    def __init__(self, folder: str):
        self.system, path = file_system(folder)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = self.system.open_output_stream(f"{path}/{self.name}", compression=None)  # the frames are the compression
        self.press = zstandard.ZstdCompressor(level=3)
        self.frames: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.filled = self.total = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """The frame of a record and its start in the frame."""
        if self.filled and self.filled + len(record) > FRAME_BYTES:
            self._flush()
        place = len(self.frames), self.filled
        self.parts.append(record)
        self.filled += len(record)
        self.total += len(record)
        return place

    def _flush(self) -> None:
        if self.parts:
            frame = self.press.compress(b"".join(self.parts))
            self.out.write(frame)
            self.frames.append((len(frame), self.filled))
            self.parts, self.filled = [], 0

    def close(self) -> None:
        self._flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(table) + len(footer)) + table + footer)
        self.out.close()


class BundleReader:
    """Reads single frames of a bundle by its seek table."""

    def __init__(self, folder: str, name: str):
        system, path = file_system(folder)
        self.file = system.open_input_file(f"{path}/{name}")
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != _SEEKABLE:
            raise ValueError(f"{name} has no seek table")
        table = np.frombuffer(self.file.read_at(8 * count, size - 9 - 8 * count), "<u4").reshape(count, 2).astype(np.int64)
        self.sizes = table
        self.starts = np.cumsum(table[:, 0]) - table[:, 0]
        self.open = zstandard.ZstdDecompressor()
        self.number, self.frame = -1, b""

    def record(self, frame: int, start: int, size: int) -> bytes:
        if frame != self.number:
            raw = self.file.read_at(int(self.sizes[frame, 0]), int(self.starts[frame]))
            self.frame, self.number = self.open.decompress(raw, max_output_size=int(self.sizes[frame, 1])), frame
        return self.frame[start:start + size]

    def close(self) -> None:
        self.file.close()


def write_bundles(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html") -> DataFrame:
    """Write every row of ``pages`` as a record into bundles under ``folder`` (on
    shared storage); the index of the records: page_id, bundle, frame, start, size.

    Of rows with equal payloads of at least 100 bytes, that with the smallest
    id is the response and the others revisit it; smaller ones are all
    responses. A null payload is empty. A row with a null id is a response and
    is never revisited; rows that repeat the smallest id are all responses. An
    empty table gives an empty index; other columns are ignored.
    """
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                        F.coalesce(pages[payload_col], F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long"))
    firsts = scratch_table(
        rows.where((F.col("size") >= LEAST_REVISIT) & F.col("page_id").isNotNull()).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"), "firsts")
    decided = rows.join(firsts, "digest", "left").select(
        "page_id", "url", "payload", "digest", "size",
        F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("refers_to"))
    make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, held = None, []
        for batch in batches:
            for page_id, url, payload, digest, size, refers_to in zip(
                    *(batch.column(c).to_pylist() if c != "payload" else batch.column(c).cast(pa.large_binary()).to_pylist()
                      for c in ("page_id", "url", "payload", "digest", "size", "refers_to"))):
                writer = writer or BundleWriter(folder)
                record = warc_record(page_id, url, payload, digest, size, refers_to)
                held.append((page_id, writer.name, *writer.add(record), len(record)))
                if writer.total >= BUNDLE_BYTES:
                    writer.close()
                    writer = None
                    yield _index(held)
                    held = []
        if writer is not None:
            writer.close()
            yield _index(held)

    return scratch_table(decided.mapInArrow(write, INDEX_SCHEMA), "warc-index")


#: bytes of records that a reading task is given
READ_BYTES = 1 << 24


def _index(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      ["page_id", "bundle", "frame", "start", "size"])


def read_records(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Read the records that ``index`` (all rows of it or some) names: page_id,
    url, payload_bytes, payload_digest, record_type, refers_to, and with
    ``with_payload`` the stored payload (null for a revisit).

    The digest of a response is taken again over the payload that was read and
    must equal the record's. An empty index gives an empty result.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, name = None, None
        for batch in batches:
            out = []
            for page_id, bundle, frame, start, size in zip(*(batch.column(c).to_pylist() for c in (
                    "page_id", "bundle", "frame", "start", "size"))):
                if bundle != name:
                    if reader is not None:
                        reader.close()
                    reader, name = BundleReader(folder, bundle), bundle
                fields, body = parse_record(reader.record(frame, start, size))
                held = re.fullmatch(r"<urn:page:(-?\d+|none)>", fields["warc-record-id"])[1]
                digest = fields["warc-payload-digest"].removeprefix("sha256:")
                kind = fields["warc-type"]
                refers = fields.get("warc-refers-to")
                if held != ("none" if page_id is None else str(page_id)):
                    raise ValueError(f"the index names page {page_id}, the record is of {held}")
                if kind == "response":
                    if hashlib.sha256(body).hexdigest() != digest:
                        raise ValueError(f"payload of page {page_id} differs from its digest")
                    length = len(body)
                else:
                    length = int(fields["x-payload-length"])
                out.append((page_id, fields["warc-target-uri"], length, digest, kind,
                            int(refers[10:-1]) if refers else None, body if kind == "response" else None))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            keep = 7 if with_payload else 6
            yield pa.RecordBatch.from_arrays(columns[:keep], names[:keep])
        if reader is not None:
            reader.close()

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    # the index is small, what it names is not: tasks by the bytes of the records
    n_bytes = index.agg(F.sum("size")).first()[0] or 0
    ordered = index.repartition(1 + n_bytes // READ_BYTES, "bundle").sortWithinPartitions("bundle", "frame", "start")
    return ordered.mapInArrow(read, schema + ", payload binary" if with_payload else schema)

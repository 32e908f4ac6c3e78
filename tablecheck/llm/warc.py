"""WARC archives as seekable Zstandard bundles.

Every task writes bundles: records are grouped into frames that decompress on their own,
and a skippable frame with the sizes of all of them, the seek table, ends the file. An
index, a row for each record, maps record ids to bundle, frame and offset within the frame.
Readers take frames by the seek table, so any record costs one frame, and frames are the
unit in which reading is spread over tasks.

Of records with equal payloads of at least ``least`` bytes the one with the largest id is
written as a response, the others as revisits that refer to it. Which these are is found
by grouping digests, never payloads.

A bundle is written to a fresh name and counts only if its task ends well, as its index
rows are then committed; what a lost executor leaves is never referred to.

Edge cases: a null payload is empty; a null address is written as ``urn:absent``; line
breaks in addresses are percent-encoded; rows with a null id are left out, as a record needs
one; rows that repeat an id with its payload count once, and of an id with different
payloads the one with the largest digest counts; an empty table writes no bundle and gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tablecheck.functions.names import field
from tablecheck.llm.common import bytes_of, rows_of, stored
from tablecheck.sources.scratch import scratch_path

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

# fixed values of the seekable format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER_BYTES = 9

INDEX = (
    "page_id long, bundle string, frame int, frame_start long, frame_bytes long, "
    "offset long, length long"
)


def record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def record(page_id: int, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the response's header and drops its payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
        payload = b""
    lines.append(f"Content-Length: {len(http) + len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """A record's WARC header, HTTP header and payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    header = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(header["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return header, http, payload


class BundleWriter:
    """One bundle: independent frames, then the seek table."""

    def __init__(self, path: str) -> None:
        self.path = path
        system, inner = fs.FileSystem.from_uri(path)
        if isinstance(system, fs.LocalFileSystem):  # other stores need no folders
            system.create_dir(inner.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(inner, compression=None)
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.at, self.buffer, self.waiting = 0, io.BytesIO(), []

    def add(self, page_id: int, data: bytes) -> list[tuple]:
        """Index rows of the frame that this record fills, if it does."""
        self.waiting.append((page_id, self.buffer.tell(), len(data)))
        self.buffer.write(data)
        return self.flush() if self.buffer.tell() >= FRAME_BYTES else []

    def flush(self) -> list[tuple]:
        if not self.waiting:
            return []
        raw = self.buffer.getvalue()
        packed = self.compressor.compress(raw)
        self.out.write(packed)
        rows = [
            (page_id, self.path, len(self.frames), self.at, len(packed), offset, length)
            for page_id, offset, length in self.waiting
        ]
        self.frames.append((len(packed), len(raw)))
        self.at += len(packed)
        self.buffer, self.waiting = io.BytesIO(), []
        return rows

    def close(self) -> list[tuple]:
        rows = self.flush()
        table = b"".join(struct.pack("<II", *frame) for frame in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)))
        self.out.write(table + footer)
        self.out.close()
        return rows


class BundleReader:
    """Frames and records of a bundle, found by its seek table."""

    def __init__(self, path: str) -> None:
        system, inner = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(inner)
        end = self.file.size()
        self.file.seek(end - FOOTER_BYTES)
        count, _, magic = struct.unpack("<IBI", self.file.read(FOOTER_BYTES))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"no seek table in {path}")
        self.file.seek(end - FOOTER_BYTES - 8 * count)
        sizes = list(struct.iter_unpack("<II", self.file.read(8 * count)))
        self.starts, at = [], 0
        for packed, raw in sizes:
            self.starts.append((at, packed, raw))
            at += packed

    def frame(self, number: int) -> bytes:
        start, packed, raw = self.starts[number]
        self.file.seek(start)
        data = zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=raw)
        if len(data) != raw:
            raise ValueError("the frame's size is not that of the seek table")
        return data

    def close(self) -> None:
        self.file.close()


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write(
    df: DataFrame,
    folder: str | None = None,
    least: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> DataFrame:
    """Write a record for every row; returns the index, stored."""
    folder = folder or scratch_path(df.sparkSession, "warc")
    pages = rows_of(
        df,
        page_id=field(id_col).cast("long"),
        url=field(url_col).cast("string"),
        payload=bytes_of(payload_col),
        digest=F.unhex(F.sha1(bytes_of(payload_col))),
    ).where("page_id IS NOT NULL")
    size = F.octet_length("payload")
    known = stored(pages.select("page_id", "digest", size.alias("size")), "warc-digests")
    chosen = known.groupBy("page_id").agg(
        F.max(F.struct("digest", "size")).alias("of"), F.count("*").alias("n")
    ).select("page_id", "of.*", "n")
    first = (
        chosen.where(F.col("size") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("last_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("digest", "last_id")
    )
    revisits = (
        chosen.join(first, "digest")
        .where((F.col("size") >= least) & (F.col("page_id") != F.col("last_id")))
        .select("page_id", F.col("last_id").alias("refers_to"))
    )
    repeated = chosen.where("n > 1").select("page_id", F.col("digest").alias("counts"))
    if not repeated.isEmpty():
        same = pages.join(repeated, "page_id", "left")
        pages = same.where("counts IS NULL OR counts = digest").drop("counts").dropDuplicates(
            ["page_id"]
        )
    schema = StructType.fromDDL(INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, bundle = to_arrow_schema(schema), None

        def indexed(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if rows:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64).to_pydict()
                for page_id, url, payload, refers_to in zip(
                    part["page_id"], part["url"], part["payload"], part["refers_to"]
                ):
                    if bundle is None:
                        bundle = BundleWriter(f"{_uri(folder)}/{uuid.uuid4().hex}.warc.zst")
                    address = _address(url)
                    data = record(page_id, address, payload, _digest(payload), refers_to)
                    yield from indexed(bundle.add(page_id, data))
                    if bundle.at >= BUNDLE_BYTES:
                        yield from indexed(bundle.close())
                        bundle = None
        if bundle is not None:
            yield from indexed(bundle.close())

    marked = pages.join(revisits, "page_id", "left").select("page_id", "url", "payload", "refers_to")
    return stored(marked.mapInArrow(run, schema), "warc-index")


def _uri(folder: str) -> str:
    return folder if "://" in folder else re.sub(r"^(file:)?/+", "file:///", folder)


def _address(url: str | None) -> str:
    return (url or "urn:absent").replace("\r", "%0D").replace("\n", "%0A")


def read_back(spark: SparkSession, index: DataFrame) -> DataFrame:
    """Every record of the index, read from its frame.

    Rows: page_id, url, record_type, record_id, refers_to_id, payload_digest (of the
    header), payload_bytes (of the HTTP header), payload (null for revisits), intact (a
    response's payload has the digest and length that its headers say).
    """
    frames = (
        index.groupBy("bundle", "frame")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "length", "page_id"))).alias("records"))
        # a frame's records, bounded by its size
    )
    # a task opens a bundle once and reads its frames in order
    bundles = index.select("bundle").distinct().count()
    frames = frames.repartition(max(1, bundles), "bundle").sortWithinPartitions("bundle", "frame")
    schema = StructType.fromDDL(
        "page_id long, url string, record_type string, record_id string, refers_to_id string, "
        "payload_digest string, payload_bytes long, payload binary, intact boolean"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, opened, reader = to_arrow_schema(schema), None, None
        for batch in batches:
            for row in batch.to_pylist():
                if opened != row["bundle"]:
                    if reader:
                        reader.close()
                    opened, reader = row["bundle"], BundleReader(row["bundle"])
                data = reader.frame(row["frame"])
                rows = [
                    _read(entry["page_id"], data[entry["offset"] : entry["offset"] + entry["length"]])
                    for entry in row["records"]
                ]
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        if reader:
            reader.close()

    return frames.mapInArrow(run, schema)


def _read(page_id: int, data: bytes) -> tuple:
    header, http, payload = parsed(data)
    if header["WARC-Record-ID"] != record_id(page_id):
        raise ValueError("the index does not lead to the record")
    revisit = header["WARC-Type"] == "revisit"
    digest = header["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    return (
        page_id, header["WARC-Target-URI"], header["WARC-Type"], header["WARC-Record-ID"],
        header.get("WARC-Refers-To"), digest, size, None if revisit else payload,
        revisit or (len(payload) == size and _digest(payload) == digest),
    )


def referred(records: DataFrame) -> DataFrame:
    """Records (without payload) with refers_to, the id of the page that a revisit means."""
    flat = stored(records.drop("payload", "url"), "warc-records")
    targets = flat.where("record_type = 'response'").select(
        F.col("record_id").alias("target"), F.col("page_id").alias("refers_to")
    )
    return flat.join(targets, flat["refers_to_id"] == targets["target"], "left").drop("target")

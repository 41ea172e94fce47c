"""WARC archives in seekable Zstandard bundles.

Pages become WARC records; equal payloads are stored once, and the others are revisit
records that refer to the page with the smallest id. Records are gathered into independent
Zstandard frames; a bundle is a file of frames that ends with a seek table in a skippable
frame, so any Zstandard tool can read it whole and a reader of one record decompresses one
frame. The index maps each record to bundle, frame and place in the decompressed frame.

Bundle names are new for each attempt of a task and the index holds only what successful
attempts wrote, so a lost executor leaves at most a file that no reader looks for.

Defined results: a null html is an empty payload. A page without an id is always a response.
Rows that share a group's smallest id are all responses; every row gives one record. Control
characters of a URL are percent-encoded; a null URL leaves the header out. Extra columns are
ignored. An empty table gives no bundles.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm._store import scratch_path, written

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 128 << 20
LEVEL = 3
#: frames that a task reads back
TASK_FRAMES = 32

# fixed values of the seekable format and of WARC 1.1
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = "urn:x-page:"

INDEX = ("page_id long, record_type string, bundle string, frame int, offset long, length long")
RECORD = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, payload binary, frame int, bundle string")


def warc_record(page_id: int | None, url: str | None, digest: str, size: int,
                payload: bytes | None, refers_to: int | None) -> bytes:
    """One record; a revisit (``refers_to``) has no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + (payload or b"")
    kind = "response" if refers_to is None else "revisit"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_PAGE}{page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        safe = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
        head.append(f"WARC-Target-URI: {safe}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_PAGE}{refers_to}>", f"WARC-Profile: {_REVISIT}",
                 f"X-Payload-Length: {size}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, payload) of the records of one decompressed frame."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        end = stop + 4 + int(head["Content-Length"])
        body = data.index(b"\r\n\r\n", stop + 4, end) + 4
        yield head, data[body:end]
        at = end + 4


class BundleWriter:
    """Frames of records in one file that ends with a seek table."""

    def __init__(self, folder: str, frame_bytes: int, level: int):
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        self.file = fs.open_output_stream(f"{path}/{self.name}", compression=None)
        self.pack = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frame_bytes, self.frames, self.written = frame_bytes, [], 0
        self.open = io.BytesIO()

    def add(self, record: bytes) -> tuple[int, int]:
        """Store a record; its frame and its place in the frame."""
        if self.open.tell() and self.open.tell() + len(record) > self.frame_bytes:
            self._end_frame()
        place = self.open.tell()
        self.open.write(record)
        return len(self.frames), place

    def _end_frame(self) -> None:
        data = self.open.getvalue()
        packed = self.pack.compress(data)
        self.file.write(packed)
        self.frames.append((len(packed), len(data)))
        self.written += len(packed)
        self.open = io.BytesIO()

    def close(self) -> None:
        if self.open.tell():
            self._end_frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, _SEEKABLE)
        self.file.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)
        self.file.close()


def seek_table(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(offset, packed size, size) of each frame of a bundle, from its footer."""
    size = file.size()
    frames, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != _SEEKABLE:
        raise ValueError("the file does not end with a seek table")
    raw = file.read_at(8 * frames, size - 9 - 8 * frames)
    out, at = [], 0
    for packed, whole in struct.iter_unpack("<II", raw):
        out.append((at, packed, whole))
        at += packed
    return out


def _open(folder: str, bundle: str) -> pa.NativeFile:
    fs, path = pafs.FileSystem.from_uri(folder)
    return fs.open_input_file(f"{path}/{bundle}")


def read_record(folder: str, bundle: str, frame: int, offset: int, length: int) -> bytes:
    """One record of a bundle, by its row of the index; reads one frame."""
    with _open(folder, bundle) as file:
        at, packed, whole = seek_table(file)[frame]
        data = zstandard.ZstdDecompressor().decompress(file.read_at(packed, at), whole)
    return data[offset:offset + length]


def _write_rows(folder: str, frame_bytes: int, bundle_bytes: int, level: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, rows = None, []
        columns = ["page_id", "record_type", "bundle", "frame", "offset", "length"]

        def index() -> pa.RecordBatch:
            types = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            cells = list(zip(*rows, strict=True)) or [[]] * len(columns)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cells, types, strict=True)], names=columns)

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, sha1, size, payload, first = (c[i].as_py() for c in batch.columns)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                record = warc_record(page, url, digest, size, payload, first)
                writer = writer or BundleWriter(folder, frame_bytes, level)
                frame, place = writer.add(record)
                rows.append((page, "response" if first is None else "revisit", writer.name,
                             frame, place, len(record)))
                if writer.written >= bundle_bytes:
                    writer.close()
                    yield index()
                    writer, rows = None, []
        if writer is not None:
            writer.close()
            yield index()
    return run


def write_bundles(pages: DataFrame, folder: str, min_bytes: int = 0,
                  frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
                  level: int = LEVEL) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to bundles below ``folder``; the index.

    Payloads of fewer than ``min_bytes`` bytes are never revisits.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("payload")).withColumns(
        {"sha1": F.sha1("payload"), "sha256": F.sha2("payload", 256),
         "size": F.octet_length("payload").cast("long")})
    keys = rows.where((F.col("size") >= min_bytes) & F.col("page_id").isNotNull()).select(
        "page_id", "sha256")
    firsts = written(keys.groupBy("sha256").agg(F.min("page_id").alias("first"),
                                                F.max("page_id").alias("last"))
                     .where("first < last").select("sha256", "first"), "firsts")
    revisits = written(keys.join(firsts, "sha256").where("page_id > first").distinct(), "revisits")
    dealt = rows.join(revisits, ["page_id", "sha256"], "left")
    return written(
        dealt.select("page_id", "url", "sha1", "size",
                     F.when(F.col("first").isNull(), F.col("payload")).alias("payload"), "first")
        .mapInArrow(_write_rows(folder, frame_bytes, bundle_bytes, level), INDEX), "index")


def _footers(folder: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle in batch.column("bundle").to_pylist():
                with _open(folder, bundle) as file:
                    table = seek_table(file)
                yield pa.RecordBatch.from_pydict({
                    "bundle": [bundle] * len(table),
                    "frame": pa.array(range(len(table)), pa.int32()),
                    "at": pa.array([f[0] for f in table], pa.int64()),
                    "packed": pa.array([f[1] for f in table], pa.int64()),
                    "whole": pa.array([f[2] for f in table], pa.int64())})
    return run


def _read_frames(folder: str, payloads: bool) -> Callable:
    def page(name: str | None) -> int | None:
        number = (name or "").removeprefix("<" + _PAGE).removesuffix(">")
        return int(number) if number not in ("", "None") else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(),
                 pa.binary(), pa.int32(), pa.string()]
        names = [c.split()[0] for c in RECORD.split(", ")]
        for batch in batches:
            opened, file = None, None
            for row in batch.to_pylist():
                if opened != row["bundle"]:
                    opened, file = row["bundle"], _open(folder, row["bundle"])
                data = unpack.decompress(file.read_at(row["packed"], row["at"]), row["whole"])
                out = []
                for head, payload in parse_records(data):
                    stored = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(head.get("X-Payload-Length", len(payload)))
                    if head["WARC-Type"] == "response":
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if digest != stored:
                            raise ValueError(f"{head['WARC-Record-ID']}: payload digest differs")
                    out.append((page(head["WARC-Record-ID"]), head.get("WARC-Target-URI"),
                                head["WARC-Type"], page(head.get("WARC-Refers-To")), size, stored,
                                payload if payloads else None, row["frame"], row["bundle"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                    names=names)
    return run


def read_bundles(bundles: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Every record of the bundles named in column ``bundle``, frame by frame."""
    frames = written(bundles.select("bundle").distinct().mapInArrow(
        _footers(folder), "bundle string, frame int, at long, packed long, whole long"), "frames")
    # rows of the frame table are small and stand for much work: a set number of tasks
    tasks = -(-frames.count() // TASK_FRAMES) or 1
    return frames.repartition(tasks, "bundle", "frame").sortWithinPartitions("bundle", "at") \
        .mapInArrow(_read_frames(folder, payloads), RECORD)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns: ``pages`` written to bundles and read back."""
    folder = scratch_path(spark, "warc")
    index = write_bundles(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_bundles(index, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload,
           min(page_id) OVER (PARTITION BY coalesce(html, '')) AS head
    FROM pages
), d AS (
    SELECT *, sha1(payload) AS digits FROM p
)
SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((16 * (strpos('0123456789abcdef', substr(digits, CAST(i * 5 // 4 + 1 AS INT), 1)) - 1)
             + strpos('0123456789abcdef', substr(digits, CAST(i * 5 // 4 + 2 AS INT), 1)) - 1)
            >> CAST(3 - i * 5 % 4 AS INT)) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = head THEN NULL ELSE head END AS refers_to
FROM d
"""

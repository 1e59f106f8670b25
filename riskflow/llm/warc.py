"""WARC archives as seekable Zstandard bundles.

Each task writes its records into bundles: records are grouped into frames of about FRAME_BYTES that decompress independently,
and a skippable frame at the end holds the seek table (Zstandard seekable format, sizes of all frames). The index maps a record
to its bundle, frame and place in the decompressed frame, so one record costs one footer and one frame to read.

A bundle's name is new for every attempt of a task, and only the index written by the attempt that succeeded names it: a task
that is lost and run again leaves at most a file that nothing refers to. Files are written through pyarrow's file systems, so
``folder`` may be local (shared by all executors), s3://, gs:// or hdfs://.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.frames import stored

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"

#: Fixed values of the seekable format: magic numbers of the skippable frame and of its footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

INDEX = "record_id string, page_id long, bundle string, frame int, offset long, length long"
RECORDS = (
    "record_id string, page_id long, uri string, record_type string, payload_digest string, payload_bytes long, "
    "refers_to long, intact boolean, bundle string, frame int, offset long"
)


def _open(path: str):
    system, inner = pa.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return system, inner


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The skippable frame that lists (compressed, decompressed) size of every frame."""
    entries = b"".join(struct.pack("<II", *s) for s in sizes)
    return struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(sizes), 0, SEEKABLE)


def frames_of(file) -> list[tuple[int, int, int]]:
    """(start, compressed, decompressed) of every frame, from the footer."""
    size = file.size()
    count, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    raw = file.read_at(count * width, size - 9 - count * width)
    out, start = [], 0
    for i in range(count):
        packed, plain = struct.unpack_from("<II", raw, i * width)
        out.append((start, packed, plain))
        start += packed
    return out


def record(record_id: str, uri: str | None, payload: bytes, refers_to: str | None, date: str = DATE) -> bytes:
    """A response with its payload, or a revisit that has only the headers of one."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {date}",
        # What is no URI character is escaped, so a URI cannot break out of its line.
        f"WARC-Target-URI: {quote(uri, safe=chr(37) + '/:?#[]@!$&()*+,;=~' + chr(39)) if uri else 'about:blank'}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
    ]
    if refers_to:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{refers_to}>",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(frame: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers in lower case, block) of every record in a decompressed frame."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        head = frame[at:end].decode().split("\r\n")
        if not head[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        headers = {k.lower(): v.strip() for k, v in (line.split(":", 1) for line in head[1:])}
        size = int(headers["content-length"])
        yield at, headers, frame[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


class _Bundle:
    """One file being written: frames as they fill up, the seek table at the end."""

    def __init__(self, folder: str, frame_bytes: int):
        self.name = f"{folder}/bundle-{uuid.uuid4().hex}.warc.zst"
        system, inner = _open(self.name)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.file, self.frame_bytes = system.open_output_stream(inner, compression=None), frame_bytes
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.sizes: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.filled = self.written = 0

    def add(self, raw: bytes) -> tuple[str, int, int, int]:
        if self.filled and self.filled + len(raw) > self.frame_bytes:
            self.flush()
        place = (self.name, len(self.sizes), self.filled, len(raw))
        self.parts.append(raw)
        self.filled += len(raw)
        return place

    def flush(self) -> None:
        packed = self.pack(b"".join(self.parts))
        self.file.write(packed)
        self.sizes.append((len(packed), self.filled))
        self.written += len(packed)
        self.parts, self.filled = [], 0

    def close(self) -> None:
        if self.filled:
            self.flush()
        self.file.write(seek_table(self.sizes))
        self.file.close()


def _writer(folder: str, frame_bytes: int, bundle_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            rows = []
            for page, uri, body, refers in zip(*batch.columns):
                if bundle is None:
                    bundle = _Bundle(folder, frame_bytes)
                page, refers = page.as_py(), refers.as_py()
                name = f"urn:uuid:{uuid.uuid4()}" if page is None else f"urn:page:{page}"
                target = None if refers is None else f"urn:page:{refers}"
                raw = record(name, uri.as_py(), (body.as_py() or "").encode(), target, date)
                rows.append((name, page, *bundle.add(raw)))
                if bundle.written >= bundle_bytes:
                    bundle.close()
                    bundle = None
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)],
                    names=["record_id", "page_id", "bundle", "frame", "offset", "length"],
                )
        if bundle is not None:
            bundle.close()

    return write


_TYPES = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    uri: str = "url",
    body: str = "html",
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Write one record per row into bundles below ``folder`` and return the index (INDEX), stored.

    Of rows with equal payloads the one with the smallest key is the response, the others are revisits of it. A null body is the
    empty payload, a null URI is about:blank. A row without a key is a response under a random record id; rows that repeat the
    smallest key of a payload are all responses. A record larger than a frame has a frame of its own. An empty table writes no
    bundle. Other columns are not read.
    """
    slim = pages.select(F.col(key).cast("long").alias("_key"), F.col(uri).alias("_uri"), F.col(body).alias("_body"))
    raw = F.coalesce("_body", F.lit("")).cast("binary")
    marks = stored(slim.select("_key", F.sha1(raw).alias("_sha1"), F.length(raw).alias("_size")), "payloads")
    first = marks.groupBy("_sha1", "_size").agg(F.min("_key").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    revisits = marks.join(first, ["_sha1", "_size"]).filter("_key != _first")
    # A key can only repeat here with another payload: the digest tells which.
    revisits = revisits.select("_key", "_sha1", "_first").distinct()
    placed = slim.withColumn("_sha1", F.sha1(raw)).join(revisits, ["_key", "_sha1"], "left")
    rows = placed.select("_key", "_uri", "_body", "_first")
    return stored(rows.mapInArrow(_writer(folder, frame_bytes, bundle_bytes, date), INDEX), "warc-index")


def _number(name: str | None) -> int | None:
    name = (name or "").strip("<>")
    return int(name[9:]) if name.startswith("urn:page:") else None


def _rows(bundle: str, frame: int, plain: bytes, wanted: set[int] | None):
    for offset, headers, block in parse(plain):
        if wanted is not None and offset not in wanted:
            continue
        name = headers["warc-record-id"].strip("<>")
        kind, said = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        intact = headers["warc-block-digest"] == f"sha1:{digest(block)}"
        if kind == "response":
            intact = intact and said == digest(payload)
        size = len(payload) if kind == "response" else None
        refers = _number(headers.get("warc-refers-to"))
        yield (name, _number(name), headers["warc-target-uri"], kind, said, size, refers, intact, bundle, frame, offset), payload


_READ = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string(),
         pa.int32(), pa.int64())
_NAMES = [x.split()[0] for x in RECORDS.split(", ")]


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bundle, frame): all records of the frame."""
    for batch in batches:
        at, file, table = None, None, []
        for bundle, frame in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if bundle != at:
                system, inner = _open(bundle)
                at, file = bundle, system.open_input_file(inner)
                table = frames_of(file)
            start, packed, plain = table[frame]
            data = zstandard.ZstdDecompressor().decompress(file.read_at(packed, start), max_output_size=plain)
            rows = [r for r, _ in _rows(bundle, frame, data, None)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _READ)], names=_NAMES)


def read_archives(index: DataFrame) -> DataFrame:
    """Read every frame that ``index`` names, once, and return its records (RECORDS).

    payload_bytes of a revisit is that of the response it refers to. ``intact``: the digests match what was read.
    """
    frames = index.select("bundle", "frame").distinct()
    tasks = max(1, frames.count() // 16)
    read = frames.repartitionByRange(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame")
    records = stored(read.mapInArrow(_reader, RECORDS), "warc-records")
    full = records.filter("record_type = 'response' and page_id is not null")
    sizes = full.select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("_size")).distinct()
    joined = records.join(sizes, ["refers_to", "payload_digest"], "left")
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", "_size")).select(*_NAMES)


def _picker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for bundle, frame, offset, length in zip(*[c.to_pylist() for c in batch.columns]):
            system, inner = _open(bundle)
            file = system.open_input_file(inner)
            start, packed, plain = frames_of(file)[frame]
            data = zstandard.ZstdDecompressor().decompress(file.read_at(packed, start), max_output_size=plain)
            for row, payload in _rows(bundle, frame, data[offset : offset + length], {0}):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[0]]), pa.array([row[1]], pa.int64()), pa.array([row[3]]), pa.array([payload], pa.binary())],
                    names=["record_id", "page_id", "record_type", "payload"],
                )


def fetch(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Single records: those of ``index`` whose record_id is in ``wanted``, each by one seek."""
    places = index.join(wanted.select("record_id").distinct(), "record_id").select("bundle", "frame", "offset", "length")
    return places.mapInArrow(_picker, "record_id string, page_id long, record_type string, payload binary")

"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that decompress on their own. A bundle is one file: its
frames, then a seek table in a skippable frame (the seekable format of Zstandard's contrib
folder), so any reader can take the file as a whole and one that knows the table can jump
to a frame. The index maps a record to its bundle, frame and offset in that frame.

Every task writes its own files under names no other attempt uses, closes them, and only
then reports them; the table of reports, written by Spark, says which files count. What a
lost or repeated task leaves behind is never read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslines.llm.common import file_system
from tslines.session import staged

#: Payloads shorter than this are never revisits.
LEAST_REVISIT = 100
#: Uncompressed bytes after which a frame, and compressed bytes after which a bundle, is closed.
FRAME_BYTES, BUNDLE_BYTES = 1 << 18, 1 << 26

# Fixed values of the formats.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "1970-01-01T00:00:00Z"

INDEX = "id long, bundle string, frame int, offset long, length long"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _header_text(value: str) -> str:
    """A value that keeps to its header line: blanks and control characters are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id: int | None, url: str, payload: bytes, digest: str, size: int, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit has the digest and length of its payload but no payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_header_text(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {size}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"X-Refers-To-Page: {'' if refers_to is None else refers_to}",
        ]
    else:
        block += payload
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """The headers and block of the record at an offset, and where the next one starts."""
    end = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:end].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no record at offset {at}")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    start = end + 4
    stop = start + int(headers["Content-Length"])
    return headers, data[start:stop], stop + 4


class BundleWriter:
    """One file of frames with a seek table at its end."""

    def __init__(self, uri: str, level: int = 3):
        files, path = file_system(uri)
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.uri, self.out = uri, files.open_output_stream(path, compression=None)
        self.tool, self.frames, self.size = zstandard.ZstdCompressor(level=level), [], 0
        self.parts, self.filled, self.places = [], 0, []

    def add(self, key: int | None, data: bytes) -> None:
        self.places.append((key, len(self.frames), self.filled, len(data)))
        self.parts.append(data)
        self.filled += len(data)
        if self.filled >= FRAME_BYTES:
            self._end_frame()

    def _end_frame(self) -> None:
        if self.filled:
            packed = self.tool.compress(b"".join(self.parts))
            self.out.write(packed)
            self.frames.append((len(packed), self.filled))
            self.size += len(packed)
            self.parts, self.filled = [], 0

    def close(self) -> list[tuple]:
        """Write the rest and the table; the places of all records."""
        self._end_frame()
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()
        return [(key, self.uri, *place) for key, *place in self.places]


def frame_offsets(file, size: int) -> list[tuple[int, int]]:
    """(offset, compressed length) of every frame, from the table at the end of a bundle."""
    file.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * count)
    lengths = [packed for packed, _ in struct.iter_unpack("<II", file.read(8 * count))]
    starts = [0]
    for n in lengths:
        starts.append(starts[-1] + n)
    return list(zip(starts, lengths, strict=False))


class BundleReader:
    """A bundle opened for reading frame by frame."""

    def __init__(self, uri: str):
        files, path = file_system(uri)
        self.file = files.open_input_file(path)
        self.frames = frame_offsets(self.file, self.file.size())
        self.tool = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        start, length = self.frames[number]
        self.file.seek(start)
        return self.tool.decompress(self.file.read(length))


def assign(df: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """(id, url, payload, digest, size, first, revisit) of every row: `first` is the smallest
    id with an equal payload of at least `LEAST_REVISIT` bytes.

    Only digests met twice are looked up, from a written table that is broadcast if small;
    the aggregation that finds them merges before its shuffle.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"), body.alias("payload"))
    rows = rows.withColumns({"digest": F.unhex(F.sha2("payload", 256)), "size": F.octet_length("payload").cast("long")})
    long = rows.where(F.col("size") >= LEAST_REVISIT).select("id", "digest")
    met = long.groupBy("digest").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1").drop("n")
    # a short payload shares no digest with a long one
    held = rows.join(staged(met, "payloads"), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return held.withColumn("revisit", revisit)


def write_bundles(df: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write a record for every row to bundles below `folder`; the index (id, bundle, frame,
    offset, length) of what counts.

    Of rows with equal payloads of at least 100 bytes those with the smallest id are
    responses, the others revisits; a null id is never the smallest, and if all are null
    all are responses. A null payload or url is empty. Repeated rows get records of their
    own, an empty table none. Other columns are not read. A task holds one frame.
    """

    def run(batches: Iterator) -> Iterator:
        bundle = None
        for batch in batches:
            for row in batch.to_pylist():
                if bundle is None:
                    bundle = BundleWriter(f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.zst")
                data = record(row["id"], row["url"], row["payload"], row["digest"].hex(), row["size"], row["first"], row["revisit"])
                bundle.add(row["id"], data)
                if bundle.size >= BUNDLE_BYTES:
                    yield _index(bundle.close())
                    bundle = None
        if bundle is not None:
            yield _index(bundle.close())

    rows = assign(df, id_col, url, payload)
    # revisits carry no payload to the writer
    stored = F.when(F.col("revisit"), F.lit(b"")).otherwise(F.col("payload")).alias("payload")
    return staged(rows.select("id", "url", stored, "digest", "size", "first", "revisit").mapInArrow(run, INDEX), "index")


def _index(places: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
    columns = zip(*places, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "bundle", "frame", "offset", "length"])


RECORD = "id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"


def _number(text: str) -> int | None:
    return int(text) if text else None


def _fields(data: bytes, at: int) -> tuple:
    """A record's row of RECORD. A response's payload is measured and must agree with its header."""
    headers, block, _ = parse_record(data, at)
    kind, digest, size = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:"), int(headers["X-Payload-Length"])
    payload = None
    if kind == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        found = hashlib.sha256(payload).hexdigest()
        if (found, len(payload)) != (digest, size):
            raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return _number(headers["X-Page-ID"]), headers["WARC-Target-URI"], kind, payload, size, digest, _number(headers.get("X-Refers-To-Page", ""))


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records an index names, read through the seek tables: page id, url, type, payload
    (null for revisits, or if not asked for), the full payload's length and digest, and
    `refers_to`.

    Work is dealt out by frame, so a bundle is read by many tasks and each frame
    decompressed once; an index filtered to some ids reads only their frames.
    """

    def run(batches: Iterator) -> Iterator:
        reader, frame, data = None, None, b""
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if (row["bundle"], row["frame"]) != frame:
                    if reader is None or frame[0] != row["bundle"]:
                        reader = BundleReader(row["bundle"])
                    frame, data = (row["bundle"], row["frame"]), reader.frame(row["frame"])
                out.append(_fields(data, row["offset"]))
            if out:
                kinds = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64())
                columns = list(zip(*out, strict=True))
                if not payloads:
                    columns[3] = (None,) * len(out)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in RECORD.split(", ")])

    frames = index.select("bundle", "frame", "offset").repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")
    return frames.mapInArrow(run, RECORD)

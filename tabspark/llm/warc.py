"""WARC archives as seekable Zstandard bundles.

Each task writes its records into bundles of its own in the shared folder: records are gathered into frames, every frame is
compressed alone, and a footer (a skippable frame that any Zstandard reader passes over) lists the sizes of all frames. The
index, a table that Spark writes, maps a record to its bundle, frame, and offset within the frame's plain bytes. To fetch a
record one reads the footer, one frame, and a slice of it.

A bundle's name holds a number that no other attempt of the task has, and the index is written only by the attempts that
succeed: what lost executors leave behind is named nowhere, and goes with `leftovers`.

Payloads are stored once: of records with equal payloads of at least `SMALLEST` bytes the one with the largest key is the
response, and the others are revisits that name it.

Defined results: a null payload is empty; null keys come first (a revisit of a record without a key refers to null); of repeated
rows one is the response and the others revisit it; an empty table gives an archive without bundles; other columns are
ignored; blanks and control characters in a URL are percent-encoded; a null URL stays null. A payload lies whole in memory.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pfs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabspark.llm.common import discard, last_written, scratch_path, settled, ship, slices, sweep, written_so_far

SMALLEST = 1000
FRAME_BYTES, BUNDLE_BYTES, LEVEL = 1 << 18, 1 << 25, 3
DATE = "2000-01-01T00:00:00Z"
#: Fixed values of the seekable format: the skippable frame's mark, the footer's mark, the footer's length.
SKIPPABLE, SEEKABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1, 9
#: Fixed values of the archive format.
VERSION, END = b"WARC/1.1", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "record string, {key}url string, record_type string, bundle string, frame int, offset bigint, length bigint"


def opened(path: str) -> tuple[pfs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        return pfs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pfs.FileSystem.from_uri(path)


class Bundle:
    """One file of frames with a footer. `add` tells the frame of a record and its place in the frame."""

    def __init__(self, folder: str, name: str, frame_bytes: int, level: int):
        store, path = opened(folder)
        store.create_dir(path, recursive=True)
        self.name, self.frame_bytes, self.written = name, frame_bytes, 0
        self.file, self.squeeze = store.open_output_stream(f"{path}/{name}", compression=None), zstandard.ZstdCompressor(level=level)
        self.open, self.sizes = bytearray(), []

    def add(self, record: bytes) -> tuple[int, int]:
        if self.open and len(self.open) + len(record) > self.frame_bytes:
            self.flush()
        place = len(self.sizes), len(self.open)
        self.open += record
        return place

    def flush(self) -> None:
        if self.open:
            packed = self.squeeze.compress(bytes(self.open))
            self.file.write(packed)
            self.sizes.append((len(packed), len(self.open)))
            self.written += len(packed)
            self.open = bytearray()

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        self.file.write(struct.pack("<II", SKIPPABLE, len(table) + FOOTER) + table + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE))
        self.file.close()


class Frames:
    """Any frame of a bundle, found through its footer."""

    def __init__(self, folder: str, name: str):
        store, path = opened(folder)
        self.file, self.expand = store.open_input_file(f"{path}/{name}"), zstandard.ZstdDecompressor()
        size = self.file.size()
        count, flags, mark = struct.unpack("<IBI", self.file.read_at(FOOTER, size - FOOTER))
        if mark != SEEKABLE:
            raise ValueError(f"{name} has no seek table")
        wide = 12 if flags & 0x80 else 8
        table = self.file.read_at(count * wide, size - FOOTER - count * wide)
        self.entries, at = [], 0
        for i in range(count):
            packed, plain = struct.unpack_from("<II", table, i * wide)
            self.entries.append((at, packed, plain))
            at += packed

    def __len__(self) -> int:
        return len(self.entries)

    def __getitem__(self, i: int) -> bytes:
        at, packed, plain = self.entries[i]
        return self.expand.decompress(self.file.read_at(packed, at), max_output_size=plain)


def head(fields: list[tuple[str, str | None]]) -> bytes:
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None).encode() + b"\r\n"


def printable(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda c: quote(c[0]), url)


def record_of(urn: str, key: str | None, url: str | None, payload: bytes, digest: str, original: tuple[str, str | None] | None, date: str) -> bytes:
    """A response, or a revisit of `original` (its record and key): the same head of HTTP, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if original else http + payload
    fields = [("WARC-Type", "revisit" if original else "response"), ("WARC-Record-ID", f"<{urn}>"), ("WARC-Date", date), ("WARC-Target-URI", urn if url is None else printable(url)),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response"), ("Source-Key", None if key is None else quote(key, safe=""))]
    if original:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{original[0]}>"), ("Refers-To-Key", None if original[1] is None else quote(original[1], safe=""))]
    return head(fields + [("Content-Length", str(len(block)))]) + block + END


def parsed(frame: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """offset, length, fields and block of every record in the plain bytes of a frame."""
    at = 0
    while at < len(frame):
        stop = frame.index(END, at)
        fields = dict(line.split(": ", 1) for line in frame[at:stop].decode().split("\r\n")[1:])
        first = stop + len(END)
        last = first + int(fields["Content-Length"])
        if frame[at:at + len(VERSION)] != VERSION or frame[last:last + len(END)] != END:
            raise ValueError("a record does not end where its head says")
        yield at, last + len(END) - at, fields, frame[first:last]
        at = last + len(END)


def originals(rows: DataFrame, smallest: int) -> DataFrame:
    """digest and size of every payload that repeats, with the key and the record of its response."""
    repeats = rows.filter(F.col("size") >= smallest).groupBy("digest", "size").agg(F.count("*").alias("n"), F.max(F.struct("key", "urn")).alias("first"))
    return settled(repeats.filter("n > 1").select("digest", "size", F.col("first.key").alias("first_key"), F.col("first.urn").alias("first_urn")), "originals")


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", smallest: int = SMALLEST,
          frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = LEVEL, date: str = DATE) -> DataFrame:
    """Write bundles into `folder`; returns the index: record, key, url, record_type, bundle, frame, offset and length in the frame."""
    ship(pages.sparkSession)
    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    # written once, so that a record keeps its number in both passes
    rows = settled(rows.select("*", F.concat(F.lit("urn:page:"), F.monotonically_increasing_id().cast("string")).alias("urn"), F.sha1("payload").alias("digest"),
                               F.octet_length("payload").cast("bigint").alias("size")), "payloads")
    rows = (rows.join(originals(rows, smallest), ["digest", "size"], "left")
            .select("key", F.col("key").cast("string").alias("name"), "url", "payload", "urn", "digest", "first_urn", F.col("first_key").cast("string").alias("first_name")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stem, number, bundle = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", 0, None
        for whole in batches:
            for some in slices(whole, "payload"):
                out = []
                columns = (some.column(c).to_pylist() for c in ("name", "url", "payload", "urn", "digest", "first_urn", "first_name"))
                for name, address, content, urn, digest, first_urn, first_name in zip(*columns):
                    if bundle is None:
                        bundle = Bundle(folder, f"{stem}-{number:05d}.warc.zst", frame_bytes, level)
                        number += 1
                        note = b"software: tabspark\r\nformat: WARC File Format 1.1\r\n"
                        bundle.add(head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(note)))]) + note + END)
                    original = (first_urn, first_name) if first_urn is not None and first_urn != urn else None
                    record = record_of(urn, name, address, content, digest, original, date)
                    frame, offset = bundle.add(record)
                    out.append((urn, address, "revisit" if original else "response", bundle.name, frame, offset, len(record)))
                    if bundle.written >= bundle_bytes:
                        bundle.close()
                        bundle = None
                kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
                arrays = [pa.array(list(v), k) for v, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
                yield pa.RecordBatch.from_arrays([arrays[0], some.column("key"), *arrays[1:]], ["record", "key", "url", "record_type", "bundle", "frame", "offset", "length"])
        if bundle is not None:
            bundle.close()

    return settled(rows.mapInArrow(work, INDEX.format(key=f"key {kind}, ")), "index")


def leftovers(index: DataFrame, folder: str) -> None:
    """Delete the bundles that the index does not name: attempts that failed have left them. Tasks delete, a listing gives the names."""
    spark = index.sparkSession
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("bundle"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = opened(folder)
        for rows in batches:
            for name in rows.column("bundle").to_pylist():
                store.delete_file(f"{path}/{name}")
            yield rows

    found.join(index.select("bundle").distinct(), "bundle", "left_anti").mapInArrow(work, "bundle string").write.format("noop").mode("overwrite").save()


def read(index: DataFrame, folder: str) -> DataFrame:
    """Every record of the bundles that the index names, from their bytes: record, name (the key as text), url, record_type, payload (null for
    a revisit), payload_bytes, payload_digest (computed for a response, and held against its head), refers_to (key as text), bundle, frame, offset, length."""
    spark = index.sparkSession
    ship(spark)
    sized = index.groupBy("bundle").agg(F.sum("length").alias("size"))
    total = index.agg(F.sum("length")).first()[0] or 0
    # repartitioning by number keeps small rows apart that stand for large files
    spread = sized.select("bundle").repartition(int(max(spark.sparkContext.defaultParallelism, total // BUNDLE_BYTES + 1)), "bundle")
    names = ["record", "name", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to", "bundle", "frame", "offset", "length"]
    kinds = [pa.string()] * 4 + [pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for bundle in rows.column("bundle").to_pylist():
                frames = Frames(folder, bundle)
                for i in range(len(frames)):
                    out = [(*told(fields, block), bundle, i, at, size) for at, size, fields, block in parsed(frames[i]) if fields["WARC-Type"] != "warcinfo"]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(zip(*out), kinds)], names)

    return spread.mapInArrow(work, "record string, name string, url string, record_type string, payload binary, payload_bytes bigint, payload_digest string, refers_to string, "
                                   "bundle string, frame int, offset bigint, length bigint")


def told(fields: dict[str, str], block: bytes) -> tuple:
    """What a record says; a response's digest is computed and must be the one in its head."""
    urn, target = fields["WARC-Record-ID"][1:-1], fields["WARC-Target-URI"]
    stop = block.index(END) + len(END)
    size = int(next(line.split(b": ", 1)[1] for line in block[:stop].split(b"\r\n") if line.startswith(b"Content-Length: ")))
    digest, payload = fields["WARC-Payload-Digest"].removeprefix("sha1:"), None
    if fields["WARC-Type"] == "response":
        payload = block[stop:]
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"the payload of {urn} is not the one its head describes")
    name, first = fields.get("Source-Key"), fields.get("Refers-To-Key")
    return (urn, None if name is None else unquote(name), None if target == urn else target, fields["WARC-Type"], payload, size, digest, None if first is None else unquote(first))


def fetch(index: DataFrame, folder: str, wanted: DataFrame) -> DataFrame:
    """The records of the keys in `wanted` (a column `key`): record, block. Of each bundle only the footer and the frames in question are read."""
    ship(index.sparkSession)
    spots = index.join(wanted.select("key").distinct(), "key", "left_semi").select("record", "bundle", "frame", "offset", "length")
    spots = spots.repartition(index.sparkSession.sparkContext.defaultParallelism, "bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, frames, plain = (None, None), None, b""
        for rows in batches:
            for record, bundle, frame, offset, length in zip(*(rows.column(c).to_pylist() for c in rows.schema.names)):
                if bundle != at[0]:
                    frames = Frames(folder, bundle)
                if (bundle, frame) != at:
                    plain, at = frames[frame], (bundle, frame)
                _, _, fields, block = next(parsed(plain[offset:offset + length]))
                if fields["WARC-Record-ID"] != f"<{record}>":
                    raise ValueError(f"{record} is not where the index says")
                yield pa.RecordBatch.from_arrays([pa.array([record]), pa.array([block], pa.binary())], ["record", "block"])

    return spots.mapInArrow(work, "record string, block binary")


def op11_warc(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages, read the bundles back, and tell of each page what its record holds; the bundles are deleted once that is written."""
    since, folder = written_so_far(), scratch_path(spark, "warc")
    index, kind = write(pages, folder), pages.schema["page_id"].dataType.simpleString()
    told_of = read(index, folder).select(F.col("name").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
    result = settled(told_of, "records")
    sweep(spark, since, last_written())
    discard(spark, folder)
    return result

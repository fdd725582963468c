"""Media columns: a Spark data source over archives of lossless grey images.

``store`` packs payloads as 8-bit grey PNG images, 64 samples a row, into archives in the shared folder: ZIP
files of stored members, so that every member is a plain file to other tools.  ``ArchiveSource`` reads such
archives: it plans byte ranges of bounded size over each archive from file lengths alone; a task reads its
archive's directory, takes the members that begin in its range, streams them in Arrow batches of bounded
bytes, and retries each member by its offset, independently of the others.
"""

from __future__ import annotations

import binascii
import hashlib
import struct
import time
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .common import scratch_path, table

#: Samples in a row of an image; payloads are padded to a positive multiple.
ROW = 64
#: Bytes of an archive before the next one is begun, bytes that one read task plans for, and bytes in an Arrow batch.
ARCHIVE_BYTES, RANGE_BYTES, BATCH_BYTES = 64 << 20, 8 << 20, 8 << 20
PNG_MAGIC = b"\x89PNG\r\n\x1a\n"


def padded(raw: bytes) -> bytes:
    """raw with bytes 0 up to a positive multiple of ROW."""
    return raw + bytes(-len(raw) % ROW or (0 if raw else ROW))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(payload: bytes) -> bytes:
    """An 8-bit grey image of ROW columns whose samples are the payload."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    filtered = np.zeros((len(rows), ROW + 1), np.uint8)
    filtered[:, 1:] = rows
    header = struct.pack(">IIBBBBB", ROW, len(rows), 8, 0, 0, 0, 0)
    return PNG_MAGIC + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(filtered.tobytes(), 4)) + _chunk(b"IEND", b"")


def decode_png(image: bytes) -> bytes:
    """The samples of an image that encode_png made; raises ValueError on damage."""
    if image[:8] != PNG_MAGIC:
        raise ValueError("not a PNG image")
    at, data, size = 8, [], None
    while at < len(image):
        (n,), kind = struct.unpack(">I", image[at : at + 4]), image[at + 4 : at + 8]
        body = image[at + 8 : at + 8 + n]
        if struct.unpack(">I", image[at + 8 + n : at + 12 + n])[0] != zlib.crc32(kind + body):
            raise ValueError(f"damaged {kind!r} chunk")
        if kind == b"IHDR":
            size = struct.unpack(">II", body[:8])
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(size[1], size[0] + 1)
    return rows[:, 1:].tobytes()


def features(payload: bytes) -> str:
    """mean, standard deviation, entropy in bits, share of samples 128 or more, row-to-row difference."""
    x = np.frombuffer(payload, np.uint8)
    p = np.bincount(x, minlength=256) / len(x)
    values = np.arange(256)
    mean = float((p * values).sum())
    deviation = float(np.sqrt(max(0.0, (p * values**2).sum() - mean**2)))
    entropy = float(-(p[p > 0] * np.log2(p[p > 0])).sum())
    rows = x.reshape(-1, ROW).astype(np.int16)
    change = float(np.abs(np.diff(rows, axis=0)).mean()) if len(rows) > 1 else 0.0
    return f"mean={mean:.4f};std={deviation:.4f};entropy={entropy:.4f};high={float(p[128:].sum()):.4f};change={change:.4f}"


class ArchiveWriter:
    """A ZIP archive of stored members, written front to back; the directory comes last (ZIP64 throughout)."""

    def __init__(self, uri: str):
        self.fs, self.path = pafs.FileSystem.from_uri(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out, self.at, self.entries = self.fs.open_output_stream(self.path), 0, []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, body: bytes) -> None:
        crc, raw = binascii.crc32(body), name.encode()
        self.entries.append((raw, crc, len(body), self.at))
        self._write(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0x800, 0, 0, 33, crc, len(body), len(body), len(raw), 0) + raw + body)

    def close(self) -> None:
        begin = self.at
        for raw, crc, n, at in self.entries:
            extra = struct.pack("<HHQ", 1, 8, at)
            self._write(struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0x800, 0, 0, 33, crc, n, n, len(raw), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + raw + extra)
        size, count, end = self.at - begin, len(self.entries), self.at
        self._write(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, count, count, size, begin))
        self._write(struct.pack("<IIQI", 0x07064B50, 0, end, 1) + struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0))
        self.out.close()


def directory(f: pa.NativeFile) -> list[tuple[str, int, int, int]]:
    """(name, crc, size, offset of the local header) of every member, in file order."""
    f.seek(f.size() - 98)
    tail = f.read(98)
    if tail[:4] != struct.pack("<I", 0x06064B50):
        raise ValueError("no archive directory")
    size, begin = struct.unpack("<QQ", tail[40:56])
    f.seek(begin)
    raw, at, out = f.read(size), 0, []
    while at < len(raw):
        _, _, _, _, _, _, _, crc, n, _, ln, le, lc, _, _, _, _ = struct.unpack("<IHHHHHHIIIHHHHHII", raw[at : at + 46])
        name = raw[at + 46 : at + 46 + ln].decode()
        out.append((name, crc, n, struct.unpack("<Q", raw[at + 50 + ln : at + 58 + ln])[0]))
        at += 46 + ln + le + lc
    return out


def read_member(f: pa.NativeFile, name: str, crc: int, size: int, offset: int) -> bytes:
    f.seek(offset)
    raw = f.read(30 + len(name.encode()) + size)
    body = raw[30 + len(name.encode()) :]
    if raw[:4] != struct.pack("<I", 0x04034B50) or len(body) != size or binascii.crc32(body) != crc:
        raise ValueError(f"damaged member {name} at {offset}")
    return body


@dataclass
class ByteRange(InputPartition):
    uri: str
    begin: int
    end: int


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options["path"].rstrip("/")
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.tries = int(options.get("tries", 4))

    def partitions(self) -> list[ByteRange]:
        fs, path = pafs.FileSystem.from_uri(self.folder)
        out = []
        for info in sorted(fs.get_file_info(pafs.FileSelector(path)), key=lambda i: i.path):
            if info.type == pafs.FileType.File and info.path.endswith(".zip"):
                uri = f"{self.folder}/{info.base_name}"
                out += [ByteRange(uri, at, min(info.size, at + self.range_bytes)) for at in range(0, info.size, self.range_bytes)]
        return out or [ByteRange("", 0, 0)]

    def _attempt(self, action):
        """action(file), opening the archive anew after each failure."""
        for k in range(self.tries):
            try:
                if self.file is None:
                    self.file = self.fs.open_input_file(self.path)
                return action(self.file)
            except (OSError, ValueError, struct.error):
                self.file = None
                if k + 1 == self.tries:
                    raise
                time.sleep(0.05 * 4**k)

    def read(self, partition: ByteRange):
        names = ["archive", "member", "offset", "media"]
        if not partition.uri:
            return
        self.fs, self.path = pafs.FileSystem.from_uri(partition.uri)
        self.file = None
        rows: list = []
        size = 0
        for name, crc, n, at in self._attempt(directory):
            if not partition.begin <= at < partition.end:
                continue
            rows.append((partition.uri, name, at, self._attempt(lambda f, m=(name, crc, n, at): read_member(f, *m))))
            size += n
            if size >= BATCH_BYTES:
                yield self._batch(rows, names)
                rows, size = [], 0
        if rows:
            yield self._batch(rows, names)

    @staticmethod
    def _batch(rows: list, names: list[str]) -> pa.RecordBatch:
        types = (pa.string(), pa.string(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


class ArchiveSource(DataSource):
    """Format ``media_archive``: (archive, member, offset, media) of a folder of archives.

    Options: path; rangeBytes, the bytes of an archive that one task plans for; tries, attempts at a member.
    """

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return "archive string, member string, offset long, media binary"

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(dict(self.options))


def store(docs: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> list[str]:
    """Writes each text as a member named by doc_id and byte count; returns the archives of the tasks that ended well.

    Archives of failed or repeated attempts keep names of their own and are deleted afterwards.
    """

    def run(batches):
        writer, done = None, []
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                writer = writer or ArchiveWriter(f"{folder}/{uuid.uuid4().hex}.zip")
                writer.add(f"{'null' if i is None else i}_{len(t or b'')}.png", encode_png(padded(t or b"")))
                if writer.at >= archive_bytes:
                    writer.close()
                    done.append(writer.path)
                    writer = None
        if writer:
            writer.close()
            done.append(writer.path)
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["path"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    kept = {r[0].rpartition("/")[2] for r in rows.mapInArrow(run, "path string").collect()}
    for info in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
        if info.base_name not in kept:
            fs.delete_file(info.path)
    return sorted(kept)


def describe(media: DataFrame) -> DataFrame:
    """Digests and features of the payloads of media_archive rows, from the stored bytes."""

    def run(batches):
        schema = pa.schema(
            {"doc_id": pa.int64(), "n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string()}
        )
        for b in batches:
            rows = []
            for member, image in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                i, n = member.removesuffix(".png").rsplit("_", 1)
                payload = decode_png(image)
                rows.append((None if i == "null" else int(i), int(n), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-ROW:]), len(image), hashlib.sha256(image).hexdigest(), features(payload)))
            cols = list(zip(*rows, strict=True)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return media.select("member", "media").mapInArrow(
        run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    )


def media_columns(docs: DataFrame) -> DataFrame:
    """Stores whole texts as images in archives, reads them back through the data source and describes them.

    Null texts count as empty and become one row of zero samples.  Null ids stay null, repeated rows give
    repeated members, other columns are ignored, an empty table gives an empty result.  Archives stay in
    the shared folder, as the result reads them when it is used.
    """
    spark = docs.sparkSession
    spark.dataSource.register(ArchiveSource)
    folder = scratch_path(spark, "media")
    store(docs, folder)
    return describe(spark.read.format("media_archive").load(folder))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(table(spark, sf_dir, "documents"))

"""Token ids in files of independent zstandard frames with a seek table.

A file is
  * frames: the ids of consecutive documents, little-endian, two bytes each if the vocabulary allows, else four;
  * a skippable frame (0x184D2A50) with the zstandard-compressed document table: id, frame, place in the frame, ids;
  * the seek table, a skippable frame (0x184D2A5E): compressed size, size and checksum (low 32 bits of XXH64) of
    each frame, then their number, a descriptor byte and the magic 0x8F92EAB1.
A reader of some documents reads the table, then only those documents' frames, and checks each one's checksum.

Documents are range-partitioned and sorted by id, a file a partition. A task that is run again writes another file;
the manifest, a Parquet table that Spark commits, names the files that count.

Defined results: null and empty texts have the end id alone; documents without an id come first; repeated ids are
kept, ordered by their text's hash; empty tables give no files and no rows; other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoloom.llm import tokens

# Fixed values of the file format.
SKIPPABLE, SEEK_SKIPPABLE, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_CHECKSUMS = 0x80

FRAME_BYTES = 256 << 10
LEVEL = 3
_TABLE = np.dtype([("has_id", "u1"), ("id", "<i8"), ("frame", "<u4"), ("place", "<u8"), ("n", "<u8")])

MANIFEST = "file_no int, file string, id_bytes int, n_documents long, n_tokens long, first_id long, last_id long, n_bytes long"


class Writer:
    """Writes one file, a frame at a time."""

    def __init__(self, uri: str, id_bytes: int):
        store, path = fs.FileSystem.from_uri(uri)
        self.out = store.open_output_stream(path, compression=None)
        self.kind = np.dtype(f"<u{id_bytes}")
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.table: list[tuple] = []
        self.frames: list[tuple[int, int, int]] = []
        self.held: list[np.ndarray] = []
        self.place = self.n_tokens = self.n_bytes = 0

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.n_bytes += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.table.append((doc_id is not None, doc_id or 0, len(self.frames), self.place, len(ids)))
        self.held.append(ids.astype(self.kind))
        self.place += len(ids)
        self.n_tokens += len(ids)
        if self.place * self.kind.itemsize >= FRAME_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.held:
            data = np.concatenate(self.held).tobytes()
            packed = self.packer.compress(data)
            self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
            self._put(packed)
            self.held, self.place = [], 0

    def close(self) -> np.ndarray:
        self._flush()
        table = np.array(self.table, dtype=_TABLE)
        packed = self.packer.compress(table.tobytes())
        self._put(struct.pack("<II", SKIPPABLE, len(packed)) + packed)
        entries = b"".join(struct.pack("<III", *frame) for frame in self.frames)
        footer = struct.pack("<IBI", len(self.frames), _CHECKSUMS, SEEK_MAGIC)
        self._put(struct.pack("<II", SEEK_SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()
        return table


class Reader:
    """Opens a file by its seek table; decompresses a frame when a document of it is asked for."""

    def __init__(self, uri: str, id_bytes: int):
        store, path = fs.FileSystem.from_uri(uri)
        self.file = store.open_input_file(path)
        self.kind = np.dtype(f"<u{id_bytes}")
        self.unpacker = zstandard.ZstdDecompressor()
        size = self.file.size()
        n, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or not descriptor & _CHECKSUMS:
            raise ValueError(f"{uri}: no seek table")
        begin = size - 9 - 12 * n - 8
        self.entries = np.frombuffer(self._at(begin + 8, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        ends = np.cumsum(self.entries[:, 0])
        self.begins = ends - self.entries[:, 0]
        after = int(ends[-1]) if n else 0
        kind, length = struct.unpack("<II", self._at(after, 8))
        if kind != SKIPPABLE:
            raise ValueError(f"{uri}: no document table")
        self.table = np.frombuffer(self.unpacker.decompress(self._at(after + 8, length)), _TABLE)
        self._last: tuple[int, np.ndarray] = (-1, np.zeros(0, self.kind))

    def _at(self, place: int, n: int) -> bytes:
        return self.file.read_at(n, int(place)) if n else b""

    def frame(self, k: int) -> np.ndarray:
        if self._last[0] != k:
            packed, size, check = (int(x) for x in self.entries[k])
            data = self.unpacker.decompress(self._at(self.begins[k], packed), max_output_size=size)
            if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {k} does not match its checksum")
            self._last = (k, np.frombuffer(data, self.kind))
        return self._last[1]

    def ids(self, row: int) -> np.ndarray:
        entry = self.table[row]
        begin = int(entry["place"])
        return self.frame(int(entry["frame"]))[begin : begin + int(entry["n"])].astype("<u4")

    def rows(self, wanted: np.ndarray | None = None) -> np.ndarray:
        """Rows of the table, or of those ids alone."""
        if wanted is None:
            return np.arange(len(self.table))
        return np.flatnonzero((self.table["has_id"] == 1) & np.isin(self.table["id"], wanted))

    def close(self) -> None:
        self.file.close()


def write_token_files(
    documents: DataFrame, folder: str, vocabulary: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Encodes every text, appends ``end_id``, and writes files and manifest under ``folder``, a path that all
    executors reach through ``pyarrow.fs``."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens.encoder(vocabulary)
        width = 2 if max(own.size - 1, end_id) < 1 << 16 else 4
        number = TaskContext.get().partitionId()
        name = f"part-{number:06d}-{uuid.uuid4().hex}.ids.zst"
        out = None
        for batch in batches:
            if batch.num_rows and out is None:
                out = Writer(f"{folder}/{name}", width)
            ids = batch.column(0).to_pylist()
            for k, own_ids in tokens.token_ids(batch.column(1), vocabulary, end_id):
                out.add(ids[k], own_ids)
        if out is not None:
            table = out.close()
            known = table["id"][table["has_id"] == 1]
            ends = (int(known.min()), int(known.max())) if len(known) else (None, None)
            row = (number, name, width, len(table), out.n_tokens, *ends, out.n_bytes)
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _MANIFEST_TYPES, strict=True)], names=_MANIFEST_NAMES)

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    placed = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    if "://" not in folder or folder.startswith("file:"):
        fs.FileSystem.from_uri(folder)[0].create_dir(fs.FileSystem.from_uri(folder)[1], recursive=True)
    placed.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")


_MANIFEST_NAMES = [c.split()[0] for c in MANIFEST.split(", ")]
_MANIFEST_TYPES = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[c.split()[1]] for c in MANIFEST.split(", ")]


def read_token_files(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Documents with ``start`` (ids of all documents before), ``n_tokens`` and ``ids`` (little-endian, four bytes
    each), from the files alone. ``doc_ids``: only those documents; files and frames without them are not read."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # One row a file; their sums, as many numbers, come before them in the order of the files.
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("file_start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    wanted = None if doc_ids is None else np.array(sorted(doc_ids), dtype=np.int64)
    if wanted is not None:
        near = F.lit(False)
        for one in sorted(set(doc_ids)):
            near = near | F.lit(one).between(F.col("first_id"), F.col("last_id"))
        files = files.filter(near)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                reader = Reader(f"{folder}/{file['file']}", file["id_bytes"])
                table = reader.table
                starts = np.concatenate([[0], np.cumsum(table["n"].astype(np.int64))[:-1]]) + file["file_start"]
                rows = reader.rows(wanted)
                for low in range(0, len(rows), 2000):
                    part = rows[low : low + 2000]
                    have = table["has_id"][part] == 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(table["id"][part], pa.int64(), mask=~have),
                            pa.array(starts[part], pa.int64()),
                            pa.array(table["n"][part].astype(np.int64)),
                            pa.array([reader.ids(int(k)).tobytes() for k in part], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )
                reader.close()

    n = max(1, manifest.count())
    spread = files.repartitionByRange(n, "file_no")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())

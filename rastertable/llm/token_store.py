"""Token ids in binary files that readers open anywhere.

A file is a row of independent zstandard frames with a seek table behind them (the public seekable
format): every frame's compressed and decompressed size and a checksum of its content. Frames hold
whole documents as little-endian ids, 16 bits wide where the vocabulary allows, else 32. The last
frame is the index: documents' ids and token counts. A reader takes the table from the file's end,
then the index, and decompresses only the frames of the documents asked for.

Files are cut by doc_id ranges and written in ascending order, each under a name of its own attempt;
only files named in the manifest, a table written by the same job, count. A lost task leaves a file
that nothing names.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.lineage import run_folder
from .common import slices, text_or_empty, texts, words
from .encoding import KnownWords

FRAME_BYTES = 1 << 18
#: Bytes of text a file holds about; a word is encoded once a file.
FILE_BYTES = 48 << 20
END_ID = 1
#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80


def _checksum(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FrameWriter:
    """Documents as frames on a stream; ``close`` adds index and seek table."""

    def __init__(self, stream, width: int, frame_bytes: int = FRAME_BYTES, level: int = 3):
        import zstandard

        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.stream, self.kind, self.most = stream, np.dtype(f"<u{width}"), frame_bytes
        self.open: list[np.ndarray] = []
        self.held, self.entries = 0, []
        self.names: list[int | None] = []
        self.sizes: list[int] = []

    def add(self, name: int | None, ids: np.ndarray) -> None:
        self.names.append(name)
        self.sizes.append(len(ids))
        self.open.append(ids.astype(self.kind))
        self.held += self.open[-1].nbytes
        if self.held >= self.most:
            self.flush()

    def frame(self, data: bytes) -> None:
        packed = self.pack(data)
        self.stream.write(packed)
        self.entries.append((len(packed), len(data), _checksum(data)))

    def flush(self) -> None:
        if self.held:
            self.frame(b"".join(x.tobytes() for x in self.open))
        self.open, self.held = [], 0

    def close(self) -> None:
        self.flush()
        known = np.array([n is not None for n in self.names], "u1")
        names = np.array([n or 0 for n in self.names], "<i8")
        head = struct.pack("<IB", len(names), self.kind.itemsize)
        self.frame(head + known.tobytes() + names.tobytes() + np.array(self.sizes, "<u8").tobytes())
        body = b"".join(struct.pack("<III", *e) for e in self.entries)
        foot = struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(body) + len(foot)) + body + foot)


class FrameReader:
    """The documents of a file that can seek; frames are checked as they are read."""

    def __init__(self, file):
        import zstandard

        self.file, self.unpack = file, zstandard.ZstdDecompressor().decompress
        end = file.seek(0, 2)
        file.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("not a file with a seek table and checksums")
        file.seek(end - 9 - 12 * n - 8)
        head = struct.unpack("<II", file.read(8))
        if head != (SKIPPABLE, 12 * n + 9):
            raise ValueError("damaged seek table")
        self.table = np.frombuffer(file.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        self.of = np.concatenate([[0], np.cumsum(self.table[:-1, 1])])  # the index holds no ids
        index = self.frame(n - 1)
        count, width = struct.unpack_from("<IB", index)
        known, names, sizes = (np.frombuffer(index, kind, count, at) for kind, at in (
            ("u1", 5), ("<i8", 5 + count), ("<u8", 5 + 9 * count)))
        self.kind = np.dtype(f"<u{width}")
        self.names = [int(x) if k else None for x, k in zip(names, known)]
        self.sizes = sizes.astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.cached: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        self.file.seek(int(self.at[k]))
        data = self.unpack(self.file.read(int(self.table[k, 0])), max_output_size=int(self.table[k, 1]))
        if _checksum(data) != self.table[k, 2]:
            raise ValueError(f"checksum of frame {k}")
        return data

    def ids(self, i: int) -> np.ndarray:
        """The ids of the file's document ``i``."""
        if not self.sizes[i]:
            return np.empty(0, self.kind)
        first = int(self.starts[i]) * self.kind.itemsize
        k = int(np.searchsorted(self.of, first, "right")) - 1
        if self.cached[0] != k:
            self.cached = (k, self.frame(k))
        return np.frombuffer(self.cached[1], self.kind, int(self.sizes[i]), first - int(self.of[k]))


def _write(folder: str, tokenizer_path: str | None, end_id: int | None):
    def run(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        known = KnownWords(tokenizer_path)
        system, path = fs.FileSystem.from_uri(folder)
        width = 2 if known.tokenizer.get_vocab_size() <= 1 << 16 else 4
        name = f"{path}/{uuid.uuid4().hex}.ids.zst"
        stream = writer = None
        for batch in batches:
            for part in slices(batch, "text"):
                if writer is None:
                    system.create_dir(path, recursive=True)
                    stream = system.open_output_stream(name, compression=None)
                    writer = FrameWriter(stream, width)
                flat, at = words(texts(part))
                ids, sizes = known.encode(flat)
                ends = np.concatenate([[0], np.cumsum(sizes)])[at]
                for doc, a, b in zip(part.column("id").to_pylist(), ends[:-1], ends[1:]):
                    own = ids[a:b]
                    writer.add(doc, own if end_id is None else np.append(own, np.uint32(end_id)))
        if writer is None:
            return
        writer.close()
        stream.close()
        yield pa.RecordBatch.from_pydict({
            "file": [name.rsplit("/", 1)[1]], "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
            "n_docs": [len(writer.sizes)], "n_ids": [int(sum(writer.sizes))]})
    return run


def write_tokens(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", tokenizer_path: str | None = None,
                 end_id: int | None = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the ids of every text, in ascending order of the integer ids; returns the manifest.

    The manifest has a row for each file: ``file``, ``part``, ``n_docs``, ``n_ids`` and ``start``, the
    ids in all files before it. Null texts are empty (the end id alone); null ids come first; rows with
    equal ids are ordered by a hash of their text. A file takes a range of ids with about
    ``file_bytes`` of text. ``tokenizer_path`` must be readable by executors.
    """
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "tokens")
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), text_or_empty(f"`{text_col}`").alias("text"))
    held = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    rows = (rows.repartitionByRange(1 + held // file_bytes, "id")
            .sortWithinPartitions("id", F.xxhash64("text")).select("id", "text"))
    files = rows.mapInArrow(_write(f"{folder}/files", tokenizer_path, end_id),
                            "file string, part int, n_docs bigint, n_ids bigint")
    files.write.parquet(f"{folder}/written")
    files = spark.read.parquet(f"{folder}/written")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    files.write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/manifest").withColumn("folder", F.lit(folder))


def _read(with_ids: bool, wanted: frozenset | None):
    def run(batches):
        from pyarrow import fs

        for batch in batches:
            for row in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(f"{row['folder']}/files/{row['file']}")
                with system.open_input_file(path) as file:
                    reader = FrameReader(file)
                    which = [i for i, n in enumerate(reader.names) if wanted is None or n in wanted]
                    for k in range(0, len(which), 2000):
                        some = which[k:k + 2000]
                        ids = [reader.ids(i).astype("<u4") for i in some]
                        out = {"doc_id": pa.array([reader.names[i] for i in some], pa.int64()),
                               "start": pa.array([row["start"] + int(reader.starts[i]) for i in some], pa.int64()),
                               "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                               "ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64())}
                        if with_ids:
                            flat = np.concatenate(ids).astype(np.int32)
                            out["ids"] = pa.ListArray.from_arrays(
                                pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids])]), pa.int32()), flat)
                        yield pa.RecordBatch.from_pydict(out)
    return run


def read_tokens(manifest: DataFrame, only: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """Documents read from the files: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids.

    ``only`` names documents; frames without any of them stay compressed. A task reads a file.
    """
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    files = manifest.repartition(max(1, manifest.count()))
    return files.mapInArrow(_read(with_ids, None if only is None else frozenset(only)),
                            schema + (", ids array<int>" if with_ids else ""))

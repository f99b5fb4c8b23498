"""Operator 2: token ids in seekable zstandard files.

A file is a run of independent zstandard frames in the public seekable format: each data frame holds up to
``frame_tokens`` ids (little-endian uint32, documents in ascending id order, long documents over several frames),
then a skippable frame with the document index, then the seek table (a skippable frame) with each frame's
compressed size, size and the low 32 bits of its XXH64.  A reader takes the table from the file's end and
decompresses only the frames that hold the requested documents; any zstandard tool decompresses the whole file.

Writing: a range shuffle by document id gives ordered partitions; each task streams its documents into one file,
written under a temporary name and then moved, so that a rerun or duplicate task replaces it by the same bytes.
A task holds one frame and the index of its file.  Files go through pyarrow's file systems (local, HDFS, S3, GS).

Defined cases: a null or empty text is a document of the end token alone; null ids come first; repeated ids are
separate documents next to each other; an empty table gives no files; extra columns are not read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import vocabulary_path, word_encoder

#: Fixed values of the public seekable zstandard format.
SKIPPABLE_SEEK_TABLE, SEEKABLE_MAGIC, CHECKSUM_FLAG = 0x184D2A5E, 0x8F92EAB1, 0x80
#: Skippable frame of this module's document index.
SKIPPABLE_INDEX = 0x184D2A50
MANIFEST = "part long, path string, n_documents long, n_tokens long, n_frames long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


class FrameWriter:
    """Writes one file: ``add(doc_id, ids)`` for each document, then ``close()``."""

    def __init__(self, out, frame_tokens: int, level: int):
        import zstandard
        self.out, self.frame_bytes = out, 4 * frame_tokens
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.pending, self.held = [], 0
        self.entries, self.ids, self.valid, self.counts = [], [], [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id or 0)
        self.valid.append(doc_id is not None)
        self.counts.append(len(ids) // 4)
        view, at = memoryview(ids), 0
        while at < len(ids):
            take = min(len(ids) - at, self.frame_bytes - self.held)
            self.pending.append(view[at:at + take])
            at, self.held = at + take, self.held + take
            if self.held == self.frame_bytes:
                self._frame()

    def _frame(self) -> None:
        import xxhash
        raw = b"".join(self.pending)
        data = self.zstd.compress(raw)
        self.out.write(data)
        self.entries.append((len(data), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.pending, self.held = [], 0

    def close(self) -> int:
        if self.held:
            self._frame()
        frames = len(self.entries)
        index = self.zstd.compress(struct.pack("<Q", len(self.ids)) + np.array(self.ids, "<i8").tobytes()
                                   + np.array(self.counts, "<i8").tobytes() + np.array(self.valid, "u1").tobytes())
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        self.entries.append((8 + len(index), 0, 0))
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        table += struct.pack("<IBI", len(self.entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table)) + table)
        return frames


class FrameReader:
    """Reads documents of one file; ``decompressed`` counts the data frames it had to open."""

    def __init__(self, source):
        import zstandard
        self.source, self.zstd, self.decompressed = source, zstandard.ZstdDecompressor(), 0
        size = source.size()
        n, flag, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("not a seekable zstandard file with checksums")
        table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(table[:, 0])])
        self.sizes, self.sums = table[:-1, 1], table[:-1, 2]
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        raw = self.zstd.decompress(self._at(int(self.offsets[n - 1]) + 8, int(table[-1, 0]) - 8))
        (docs,) = struct.unpack("<Q", raw[:8])
        self.ids = np.frombuffer(raw, "<i8", docs, 8)
        self.counts = np.frombuffer(raw, "<i8", docs, 8 + 8 * docs)
        self.valid = np.frombuffer(raw, "u1", docs, 8 + 16 * docs).astype(bool)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self._held = (-1, b"")

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(n)

    def _frame(self, i: int) -> bytes:
        import xxhash
        if self._held[0] != i:
            raw = self.zstd.decompress(self._at(int(self.offsets[i]), int(self.offsets[i + 1] - self.offsets[i])))
            if len(raw) != self.sizes[i] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[i]:
                raise ValueError(f"frame {i}: checksum differs")
            self.decompressed += 1
            self._held = (i, raw)
        return self._held[1]

    def document(self, i: int) -> bytes:
        """Ids of the i-th document of the file as bytes."""
        at, end, parts = 4 * int(self.starts[i]), 4 * int(self.starts[i + 1]), []
        k = int(np.searchsorted(self.first, at, "right")) - 1
        while at < end:
            raw, base = self._frame(k), int(self.first[k])
            parts.append(raw[at - base:end - base])
            at = base + len(raw)
            k += 1
        return b"".join(parts)


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def _writer(folder: str, vocabulary: str, end_id: int, frame_tokens: int, level: int):
    def run(batches):
        from pyspark import TaskContext
        task = TaskContext.get()
        encoder, end = word_encoder(vocabulary), end_id.to_bytes(4, "little")
        out = writer = None
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                if out is None:
                    files, base = _filesystem(folder)
                    files.create_dir(base, recursive=True)
                    name = f"part-{task.partitionId():06d}.zst"
                    temporary = f"{base}/_{name}-{task.taskAttemptId()}"
                    out = files.open_output_stream(temporary)
                    writer = FrameWriter(out, frame_tokens, level)
                writer.add(doc, encoder.encode(text.as_py()) + end)
        if out is not None:
            frames = writer.close()
            out.close()
            files.move(temporary, f"{base}/{name}")
            row = [[task.partitionId()], [f"{folder}/{name}"], [len(writer.ids)], [sum(writer.counts)], [frames]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[0], pa.int64()), pa.array(row[1]), *(pa.array(r, pa.int64()) for r in row[2:])],
                ["part", "path", "n_documents", "n_tokens", "n_frames"])
    return run


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", *,
                 vocabulary: str | None = None, end_id: int = 2, files: int | None = None,
                 frame_tokens: int = 1 << 16, level: int = 1) -> DataFrame:
    """Tokenize and write ``docs`` in ascending id order into ``folder`` (a URI all executors share).

    ``files`` (default spark.sql.shuffle.partitions) sets the number of files: size it to the data.  Returns the
    manifest, also kept as Parquet under ``folder/_manifest``: one row per file."""
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = vocabulary or vocabulary_path("word_bpe_49k.json")
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .repartitionByRange(files, F.col("doc_id").asc_nulls_first())
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first()))
    rows.mapInArrow(_writer(folder, path, end_id, frame_tokens, level), MANIFEST).write.parquet(f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def _reader(wanted: frozenset | None, with_ids: bool):
    def run(batches):
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                files, name = _filesystem(path)
                with files.open_input_file(name) as source:
                    reader = FrameReader(source)
                    n = len(reader.ids)
                    pick = range(n) if wanted is None else np.flatnonzero(
                        reader.valid & np.isin(reader.ids, np.fromiter(wanted, np.int64))).tolist()
                    rows, size = [], 0
                    for i in pick:
                        ids = reader.document(i)
                        rows.append((int(reader.ids[i]) if reader.valid[i] else None, base + int(reader.starts[i]),
                                     len(ids) // 4, zlib.crc32(ids), ids if with_ids else None))
                        size += len(ids) if with_ids else 40
                        if size > 1 << 22:
                            yield _rows(rows)
                            rows, size = [], 0
                    if rows:
                        yield _rows(rows)
    return run


def _rows(rows):
    doc, start, n, crc, ids = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64()),
         pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])


def read_tokens(spark: SparkSession, folder: str, doc_ids=None, with_ids: bool = True) -> DataFrame:
    """Documents of a written folder: doc_id, start (ids of all documents before it), n_tokens, the crc32 of its ids
    and the ids.  ``doc_ids``: only these (a short list), decompressing only the frames that hold them."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = manifest.withColumn("base", F.coalesce(before, F.lit(0)))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = None if doc_ids is None else frozenset(int(x) for x in doc_ids)
    return (parts.repartitionByRange(n, "part").select("path", "base")
            .mapInArrow(_reader(wanted, with_ids), DOCUMENTS))

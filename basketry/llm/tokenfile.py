"""Token-id files: independent zstandard frames with a trailing seek table.

A file is a sequence of zstandard frames, each holding the packed ids of some
whole documents, then two skippable frames: the document index (zstandard
compressed) and, in the public seekable format, the seek table with compressed
size, decompressed size and checksum of every frame. Any zstandard reader can
decompress the whole file; a reader of single documents fetches the table, the
index and only the frames it needs, and checks each frame it opens.

Documents are range-partitioned by id, so files and the documents inside them
ascend. Every task writes a file of its own name per attempt and returns its
manifest row; only rows of successful attempts reach the manifest, so lost or
repeated attempts leave nothing that is read. Files are reached through
pyarrow's file systems by the URI of the shared folder.

Null texts count as empty, null ids sort first, equal ids order by text, and a
document longer than a frame gets a frame of its own size. An empty table gives
no rows.
"""

from __future__ import annotations

import io
import os
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.bpe import PieceCache, byte_letters
from basketry.llm.common import Workspace, partitions, ship_package

# Fixed values of the public seekable zstandard format.
SKIPPABLE_SEEK, SKIPPABLE_INDEX, SEEKABLE_MAGIC = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
FRAME_IDS = 65_536
LEVEL = 3

MANIFEST = "file_no int, path string, n_docs long, n_tokens long, n_bytes long"
ROWS = "file_no int, doc_no long, doc_id long, start long, ids binary"


class LibraryEncoder(PieceCache):
    """Ids by the tokenizers library; each distinct piece is encoded once
    while it stays in the worker's bounded tables."""

    def __init__(self, path: str):
        super().__init__(chunk_entries=1_000_000, word_entries=500_000)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize  # the merges alone; the pattern has already been applied
        self.letters = {b: letter for letter, b in byte_letters().items()}
        self.added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}

    def encode_word(self, word: str) -> bytes:
        letters = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenize(letters)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_marked(texts, self.added)


@lru_cache(maxsize=2)
def encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class FrameWriter:
    """Writes documents (id, packed 32-bit ids) to a binary stream. Ids are
    stored in ``width`` bytes each, 2 if the vocabulary allows it."""

    def __init__(self, out, width: int, frame_ids: int = FRAME_IDS):
        self.out, self.width, self.frame_ids = out, width, frame_ids
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False)
        self.table, self.frame_docs = [], []
        self.doc_ids, self.doc_null, self.lengths = array("q"), bytearray(), array("Q")
        self.pending, self.pending_ids, self.pending_docs = [], 0, 0
        self.n_tokens = 0

    def add(self, doc_id: int | None, packed: bytes) -> None:
        self.doc_ids.append(doc_id or 0)
        self.doc_null.append(doc_id is None)
        n = len(packed) // 4
        self.lengths.append(n)
        self.pending.append(packed)
        self.pending_ids += n
        self.pending_docs += 1
        self.n_tokens += n
        if self.pending_ids >= self.frame_ids:
            self._flush()

    def _flush(self) -> None:
        if not self.pending_docs:
            return
        ids = np.frombuffer(b"".join(self.pending), dtype="<u4")
        raw = ids.astype("<u2").tobytes() if self.width == 2 else ids.tobytes()
        frame = self.zstd.compress(raw)
        self.out.write(frame)
        self.table.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.frame_docs.append(self.pending_docs)
        self.pending, self.pending_ids, self.pending_docs = [], 0, 0

    def close(self) -> None:
        self._flush()
        index = struct.pack("<IIQ", self.width, len(self.frame_docs), len(self.lengths))
        index += array("Q", self.frame_docs).tobytes() + self.doc_ids.tobytes() + bytes(self.doc_null) + self.lengths.tobytes()
        packed = struct.pack("<Q", len(index)) + self.zstd.compress(index)
        packed += struct.pack("<I", xxhash.xxh64_intdigest(packed) & 0xFFFFFFFF)
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(packed) + 4) + packed + struct.pack("<I", len(packed)))
        body = b"".join(struct.pack("<III", *row) for row in self.table)
        body += struct.pack("<IBI", len(self.table), 0x80, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(body)) + body)


class FrameReader:
    """Random access to a token file through a seekable binary stream."""

    def __init__(self, stream, size: int):
        self.stream = stream
        n_frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & 0x80:
            raise ValueError("not a seekable token file")
        table_at = size - 9 - 12 * n_frames - 8
        head, length = struct.unpack("<II", self._at(table_at, 8))
        if head != SKIPPABLE_SEEK or length != 12 * n_frames + 9:
            raise ValueError("broken seek table")
        self.table = np.frombuffer(self._at(table_at + 8, 12 * n_frames), dtype="<u4").reshape(n_frames, 3)
        self.offsets = np.concatenate([[0], np.cumsum(self.table[:, 0].astype(np.int64))])
        (n_packed,) = struct.unpack("<I", self._at(table_at - 4, 4))
        packed = self._at(table_at - 4 - n_packed, n_packed)
        if xxhash.xxh64_intdigest(packed[:-4]) & 0xFFFFFFFF != struct.unpack("<I", packed[-4:])[0]:
            raise ValueError("document index fails its checksum")
        (n_index,) = struct.unpack("<Q", packed[:8])
        index = zstandard.ZstdDecompressor().decompress(packed[8:-4], max_output_size=n_index)
        self.width, n_frames, n_docs = struct.unpack("<IIQ", index[:16])
        at = 16
        self.frame_docs = np.frombuffer(index, "<u8", n_frames, at).astype(np.int64)
        at += 8 * n_frames
        self.doc_ids = np.frombuffer(index, "<i8", n_docs, at)
        at += 8 * n_docs
        self.doc_null = np.frombuffer(index, "u1", n_docs, at).astype(bool)
        self.lengths = np.frombuffer(index, "<u8", n_docs, at + n_docs).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.first_doc = np.concatenate([[0], np.cumsum(self.frame_docs)])

    def _at(self, offset: int, n: int) -> bytes:
        self.stream.seek(int(offset))
        return self.stream.read(int(n))

    def frame(self, k: int) -> np.ndarray:
        """Ids of frame ``k``, checked against the seek table."""
        size, raw_size, checksum = (int(x) for x in self.table[k])
        raw = zstandard.ZstdDecompressor().decompress(self._at(self.offsets[k], size), max_output_size=max(raw_size, 1))
        if len(raw) != raw_size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} fails its checksum")
        return np.frombuffer(raw, dtype="<u2" if self.width == 2 else "<u4").astype("<u4", copy=False)

    def documents(self, frames=None, wanted: set[int] | None = None) -> Iterator[tuple[int, int | None, int, bytes]]:
        """(position, id, first token, packed ids), of the given frames and
        ids; frames without a wanted id are never read."""
        for k in range(len(self.frame_docs)) if frames is None else frames:
            lo, hi = int(self.first_doc[k]), int(self.first_doc[k + 1])
            hits = [d for d in range(lo, hi) if wanted is None or (not self.doc_null[d] and int(self.doc_ids[d]) in wanted)]
            if not hits:
                continue
            ids = self.frame(k)
            base = int(self.starts[lo])
            for d in hits:
                s = int(self.starts[d])
                packed = ids[s - base: s - base + int(self.lengths[d])].tobytes()
                yield d, None if self.doc_null[d] else int(self.doc_ids[d]), s, packed


def write(df: DataFrame, vocabulary: str, end_id: int, work: Workspace,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode all texts, append ``end_id`` to each and write the files below
    ``work``; returns the manifest (``MANIFEST``), itself a written table."""
    ship_package(df.sparkSession)
    base = f"{work.base}/tokens"
    work._fs.mkdirs(work._path(base))

    def run(batches: Iterator[pa.RecordBatch]):
        task = TaskContext.get()
        enc, tail = encoder(vocabulary), array("I", [end_id]).tobytes()
        top = max(enc.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        writer = stream = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                if writer is None:
                    path = f"{base}/part-{task.partitionId():06d}-{task.taskAttemptId()}.tok"
                    fs, inner = _filesystem(path)
                    stream = fs.open_output_stream(inner)
                    writer = FrameWriter(stream, 2 if top <= 65_536 else 4)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc_id, packed in zip(part.column(0).to_pylist(), enc.encode(texts)):
                    writer.add(doc_id, packed + tail)
        if writer is not None:
            writer.close()
            n_bytes = stream.tell()
            stream.close()
            row = [[task.partitionId()], [path], [len(writer.lengths)], [writer.n_tokens], [n_bytes]]
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)],
                                             names=["file_no", "path", "n_docs", "n_tokens", "n_bytes"])

    n = partitions(df.sparkSession)
    ordered = (df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
               .repartitionByRange(n, F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()))
    return work.save(ordered.mapInArrow(run, MANIFEST), "manifest")


def read(manifest: DataFrame, wanted: set[int] | None = None) -> DataFrame:
    """Documents of the files (``ROWS``) with ``start``, the number of ids of
    all documents before; with ``wanted`` ids only the frames that hold one of
    them are fetched and decompressed. The manifest has one row per file, so
    its running sum is small, and it travels with the file names: joining it
    to the documents would let the planner take them for a small table."""
    def run(batches: Iterator[pa.RecordBatch]):
        names = ["file_no", "doc_no", "doc_id", "start", "ids"]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for file_no, path, before in zip(*(batch.column(i).to_pylist() for i in range(3))):
                fs, inner = _filesystem(path)
                with fs.open_input_file(inner) as stream:
                    reader = FrameReader(stream, stream.size())
                    for k in range(len(reader.frame_docs)):
                        rows = [(file_no, d, i, before + s, ids) for d, i, s, ids in reader.documents([k], wanted)]
                        if rows:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(v, t) for v, t in zip(zip(*rows), types)], names=names)

    ship_package(manifest.sparkSession)
    w = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file_no", "path", F.coalesce(F.sum("n_tokens").over(w), F.lit(0)).alias("before"))
    return files.repartition(partitions(manifest.sparkSession), "file_no").mapInArrow(run, ROWS)


def read_stream(data: bytes) -> FrameReader:
    """Reader over bytes in memory, for tests and small files."""
    return FrameReader(io.BytesIO(data), len(data))

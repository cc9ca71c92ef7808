"""Token ids in files of compressed bit or byte planes.

Ids are cut into chunks of a fixed number of ids, whatever the documents' ends. A chunk is
transposed: plane i holds bit i (or byte i) of all its ids, so that the steady upper part of
the ids lies together. Each plane is a zstandard frame of its own; planes above the largest id
of a chunk are not stored. A file ends with its index: place and number of ids of each chunk,
lengths of its planes, and blocks with the documents' ids and lengths. So a reader can fetch
any stretch of ids without touching the rest.

    plane frames ... document blocks ... index (zstandard of JSON) | its length, 8 bytes | MAGIC

Documents are dealt to files by ranges of doc_id, so that file after file gives ascending
doc_ids. A task streams its range into one file and holds a chunk at a time. Every attempt of a
task writes a file of its own name; which ones count is said by the table ``index``, which Spark
commits, so lost executors and repeated attempts leave no half files in the result.

Defined results. A null text is empty, and an empty document is the end id alone. Null doc_ids
come first. Repeated doc_ids and repeated rows are documents of their own, next to each other;
equal rows are dealt to files by their position in the input, which is read twice and should be
a stored table. A document may span chunks, not files. An empty table gives no files and no
rows. Other columns are ignored, also those named like the results.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adfeed.llm.common import octets, task
from adfeed.llm.lm import packed, unpacked
from adfeed.llm.packing import TOKENIZER, token_ids

MAGIC = b"IDPLANE1"
CHUNK = 1 << 16  # ids
DOCUMENTS = 1 << 16  # of one block
LEVEL = 3

FILES = pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("bytes", pa.int64())])
FILES_DDL = "part int, file string, n_docs long, n_ids long, bytes long"
READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
READ_DDL = "doc_id long, start long, n_tokens long, ids_crc32 long"


def planes_of(ids: np.ndarray, kind: str) -> list[np.ndarray]:
    """The planes of 32-bit ids, lowest first: of bits, or of bytes."""
    width = max(1, int(ids.max(initial=0)).bit_length())
    parts = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)[:, : -(-width // 8)]
    if kind == "byte":
        return list(np.ascontiguousarray(parts.T))
    return list(np.packbits(np.unpackbits(parts, axis=1, bitorder="little")[:, :width].T, axis=1, bitorder="little"))


def ids_of(planes: list[bytes], count: int, kind: str) -> np.ndarray:
    """The ``count`` ids that gave these planes."""
    rows = np.stack([np.frombuffer(p, np.uint8) for p in planes])
    if kind == "bit":
        rows = np.packbits(np.unpackbits(rows, axis=1, count=count, bitorder="little"), axis=0, bitorder="little")
    out = np.zeros((count, 4), np.uint8)
    out[:, : len(rows)] = rows.T
    return out.view("<u4")[:, 0]


class IdWriter:
    """Takes documents one by one; ``close`` writes what is left, and the index."""

    def __init__(self, sink, kind: str, chunk: int = CHUNK):
        self.sink, self.kind, self.chunk = sink, kind, chunk
        self.at = self.n_docs = self.n_ids = 0
        self.held, self.waiting, self.documents = [], 0, []
        self.chunks, self.blocks = [], []
        self.press = zstandard.ZstdCompressor(level=LEVEL).compress

    def _put(self, data: bytes) -> int:
        self.sink.write(data)
        self.at += len(data)
        return len(data)

    def _chunk(self, ids: np.ndarray) -> None:
        self.chunks.append([self.at, len(ids), [self._put(self.press(p.tobytes())) for p in planes_of(ids, self.kind)]])

    def _block(self) -> None:
        names, lengths = zip(*self.documents)
        columns = [[n is None for n in names], [n or 0 for n in names], lengths]
        self.blocks.append([self.at, len(names), [self._put(packed(np.array(c, np.int64))) for c in columns]])
        self.documents = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.waiting += len(ids)
        self.n_ids += len(ids)
        self.n_docs += 1
        if self.waiting >= self.chunk:
            joined = np.concatenate(self.held)
            whole = len(joined) // self.chunk * self.chunk
            for at in range(0, whole, self.chunk):
                self._chunk(joined[at : at + self.chunk])
            self.held, self.waiting = [joined[whole:].copy()], len(joined) - whole
        self.documents.append((doc_id, len(ids)))
        if len(self.documents) == DOCUMENTS:
            self._block()

    def close(self) -> None:
        if self.waiting:
            self._chunk(np.concatenate(self.held))
        if self.documents:
            self._block()
        index = {"kind": self.kind, "chunk": self.chunk, "chunks": self.chunks, "documents": self.blocks}
        length = self._put(self.press(json.dumps(index).encode()))
        self._put(length.to_bytes(8, "little") + MAGIC)


class IdFile:
    """Reads a file by its index; ``source`` is an open Arrow file."""

    def __init__(self, source):
        self.source, size = source, source.size()
        tail = source.read_at(16, size - 16) if size >= 16 else b""
        if tail[8:] != MAGIC:
            raise ValueError("no complete file of id planes")
        length = int.from_bytes(tail[:8], "little")
        index = json.loads(zstandard.decompress(source.read_at(length, size - 16 - length)))
        self.kind, self.chunk, self.chunks, self.blocks = index["kind"], index["chunk"], index["chunks"], index["documents"]

    def _frames(self, at: int, lengths: list[int]) -> list[bytes]:
        data, edges = self.source.read_at(sum(lengths), at), np.cumsum([0, *lengths]).tolist()
        return [data[a:b] for a, b in zip(edges, edges[1:])]

    def ids(self, chunk: int) -> np.ndarray:
        at, count, lengths = self.chunks[chunk]
        return ids_of([zstandard.decompress(f) for f in self._frames(at, lengths)], count, self.kind)

    def stretch(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from ``start`` on, counted within the file; only their chunks are read."""
        first, last = start // self.chunk, (start + max(count, 1) - 1) // self.chunk
        found = np.concatenate([self.ids(i) for i in range(first, last + 1)])
        return found[start - first * self.chunk :][:count]

    def documents(self) -> Iterator[tuple[int | None, int]]:
        """(doc_id, number of ids) in the order of the file."""
        for at, _, lengths in self.blocks:
            missing, names, counts = (unpacked(f).tolist() for f in self._frames(at, lengths))
            yield from ((None if m else n, c) for m, n, c in zip(missing, names, counts))

    def parts(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """(doc_id, number of ids, its ids piece by piece): one chunk is held at a time. Pieces have to be taken before the next document."""
        chunk, held = -1, np.empty(0, np.uint32)

        def pieces(left: int) -> Iterator[np.ndarray]:
            nonlocal chunk, held
            while left:
                if not len(held):
                    chunk += 1
                    held = self.ids(chunk)
                piece, held = held[:left], held[left:]
                left -= len(piece)
                yield piece

        for doc_id, count in self.documents():
            yield doc_id, count, pieces(count)


def write_ids(
    docs: DataFrame,
    path: str,
    kind: str = "byte",
    end: int = 0,
    file_bytes: int = 64 << 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str = TOKENIZER,
) -> DataFrame:
    """Write the files and return their table, kept under ``path``/index: part, file, n_docs, n_ids, bytes.

    ``path`` is a folder that all executors reach, by a scheme that Arrow knows. ``kind``: "byte" or "bit"
    planes. ``end``: the id after each document. ``file_bytes``: text for each file, about.
    """
    if kind not in ("byte", "bit"):
        raise ValueError("kind is byte or bit")
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    size = source.agg(F.sum(octets("text") + 1)).first()[0] or 0
    row = F.monotonically_increasing_id()  # so that copies of one row need not share a file
    ranged = source.withColumn("_row", row).repartitionByRange(1 + size // file_bytes, "doc_id", "_row").sortWithinPartitions("doc_id", "_row")
    files, base = fs.FileSystem.from_uri(path)
    files.create_dir(base, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, (files, base), here = token_ids(tokenizer), fs.FileSystem.from_uri(path), TaskContext.get()
        name, writer = f"ids-{here.partitionId():06d}-{here.taskAttemptId()}.planes", None
        last = np.array([end], np.uint32)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if writer is None:
                    sink = files.open_output_stream(f"{base}/{name}")
                    writer = IdWriter(sink, kind)
                writer.add(doc_id, np.append(encode(text.as_py() or ""), last))
        if writer:
            writer.close()
            sink.close()
            row = [[here.partitionId()], [name], [writer.n_docs], [writer.n_ids], [writer.at]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, FILES)], schema=FILES)

    ranged.select("doc_id", "text").mapInArrow(task(write), FILES_DDL).write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document in the files under ``path``."""
    index = spark.read.parquet(f"{path}/index")
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n_ids")
    count = max(1, index.count())
    starts = index.select("part", "file", before.alias("start")).repartitionByRange(count, "part")
    schema = READ.append(pa.field("ids", pa.list_(pa.int64()))) if with_ids else READ
    limit = 2_000 if with_ids else 50_000

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(path)
        for batch in batches:
            for name, start in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rows: list[tuple] = []
                with files.open_input_file(f"{base}/{name}") as source:
                    for doc_id, n, pieces in IdFile(source).parts():
                        crc, kept = 0, []
                        for piece in pieces:
                            crc = zlib.crc32(piece.tobytes(), crc)
                            if with_ids:
                                kept.append(piece)
                        rows.append((doc_id, start, n, crc, *([np.concatenate(kept).astype(np.int64)] if with_ids else [])))
                        start += n
                        if len(rows) >= limit:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return starts.mapInArrow(task(read), READ_DDL + (", ids array<long>" if with_ids else ""))

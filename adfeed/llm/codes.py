"""Vectors as codes of a product codebook, by memoised grid cells.

Components become integers, floor(256 * x), and a vector is cut into equal consecutive parts.
Each part position has a codebook; a part's code is the nearest entry. All arithmetic is on
integers, so the result does not hang on the order of rows or tasks.

Nearest entries are found by the cell of a coarse grid that a part lies in. For a new cell, the
smallest and the largest distance of each entry over the cell's box are compared: an entry whose
smallest distance exceeds another one's largest is nearest nowhere in the box. What is left is
kept under the hash of the cell, and only that is evaluated exactly for the parts of the cell.
A task remembers ``remembered`` cells of each position; it works out other cells each time they
come, so the bound costs time and changes no result. The same holds for two cells of one hash.

A round of training is one job: tasks send one row of sums for each entry they used, Spark adds
them, and the driver gets (positions x entries) rows. The codebook is all that is broadcast;
its size is fixed by the parameters and the dimension.

Defined results. A vector that is null, empty or holds null or non-finite components is dropped.
Vectors of other lengths than the first one's, or lengths that the number of parts does not
divide, raise an error, as do components beyond 2^18, whose distances would not fit 64 bits. Null
vec_ids come last in the order of vec_ids; rows that tie there are ordered by their components.
Repeated rows are vectors of their own. Fewer rows than entries give smaller codebooks. An empty
table gives no rows. Other columns are ignored, also those named like the results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfeed.llm.common import mixed, task, written

LARGEST = 1 << 26  # of a component as integer: squares of differences over 512 positions still fit 64 bits
ROWS = 8192  # evaluated at once


class Cells:
    """Nearest entries of one codebook (entries x positions, integers)."""

    def __init__(self, book: np.ndarray, width: int, remembered: int):
        self.book, self.width, self.remembered = book, width, remembered
        self.place: dict[int, int] = {}
        self.cells = np.empty((0, book.shape[1]), np.int64)
        self.near = np.empty((0, len(book)), bool)
        self.evaluated = self.made = 0

    def survivors(self, cells: np.ndarray) -> np.ndarray:
        """Entries not dominated across the box of each cell (cells x entries)."""
        low = (cells * self.width)[:, None, :]
        high = low + (self.width - 1)
        entries = self.book[None, :, :]
        least = (np.maximum(np.maximum(low - entries, entries - high), 0) ** 2).sum(2)
        most = (np.maximum(np.abs(entries - low), np.abs(entries - high)) ** 2).sum(2)
        self.made += len(cells)
        return least <= most.min(1)[:, None]

    def _lookup(self, keys: list[int], cells: np.ndarray) -> np.ndarray:
        """The survivors of distinct cells, out of the memory or worked out."""
        at = np.fromiter((self.place.get(k, -1) for k in keys), np.int64, len(keys))
        known = at >= 0
        if len(self.cells):  # another cell of the same hash is not this one
            known &= (self.cells[np.maximum(at, 0)] == cells).all(1)
        out = np.empty((len(keys), len(self.book)), bool)
        out[known] = self.near[at[known]]
        new = np.flatnonzero(~known)
        for some in np.array_split(new, -(-len(new) // 1024)) if len(new) else ():
            out[some] = self.survivors(cells[some])
        free = np.flatnonzero(~known & (at < 0))[: max(0, self.remembered - len(self.cells))]
        if len(free):
            self.place.update(zip([keys[i] for i in free], range(len(self.cells), len(self.cells) + len(free))))
            self.cells = np.concatenate([self.cells, cells[free]])
            self.near = np.concatenate([self.near, out[free]])
        return out

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each part; ties go to the lower entry."""
        cells = parts // self.width
        keys = np.zeros(len(parts), np.uint64)
        for i in range(cells.shape[1]):
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + cells[:, i].astype(np.uint64))
        distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
        near = self._lookup(distinct.tolist(), cells[first])[back]
        near[(cells[first][back] != cells).any(1)] = True  # a second cell of one hash in these rows
        row, entry = np.nonzero(near)
        distance = ((parts[row] - self.book[entry]) ** 2).sum(1)
        self.evaluated += len(row)
        starts = np.searchsorted(row, np.arange(len(parts)))
        least = np.minimum.reduceat(distance, starts)
        hit = np.flatnonzero(distance == least[row])
        hit = hit[np.unique(row[hit], return_index=True)[1]]
        return entry[hit], least


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches put together to about ROWS rows, with their components."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= ROWS:
            yield block(held)
            held, count = [], 0
    if count:
        yield block(held)


def block(held: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
    rows = pa.Table.from_batches(held).combine_chunks()
    return rows, rows.column("x").chunk(0).flatten().to_numpy().reshape(rows.num_rows, -1)


def kept_vectors(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """vec_id, label, x (array of integers) of the rows with a whole vector, stored once."""
    x = F.col("x")
    whole = (F.size(x) > 0) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("x")
    ).where(x.isNotNull() & whole)
    near = F.when(F.exists(x, lambda v: F.abs(v) >= float(LARGEST // 256)), F.raise_error(F.lit("a component beyond 2^18")).cast("array<long>"))
    return written(rows.select("vec_id", "label", near.otherwise(F.transform(x, lambda v: F.floor(v * 256))).alias("x")), "integers")


def _sums(books: np.ndarray, width: int, remembered: int, schema: pa.Schema):
    def run(batches):
        positions, entries, size = books.shape
        cells = [Cells(book, width, remembered) for book in books]
        count, sums = np.zeros((positions, entries), np.int64), np.zeros(books.shape, np.int64)
        for _, x in blocks(batches):
            parts = x.reshape(len(x), positions, size)
            for i in range(positions):
                entry, _ = cells[i].nearest(parts[:, i])
                count[i] += np.bincount(entry, minlength=entries)
                np.add.at(sums[i], entry, parts[:, i])
        position, entry = np.nonzero(count)
        if len(position):
            columns = [position, entry, count[position, entry], *sums[position, entry].T]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _coded(books: np.ndarray, width: int, remembered: int):
    def run(batches):
        positions, _, size = books.shape
        cells = [Cells(book, width, remembered) for book in books]
        for rows, x in blocks(batches):
            parts = x.reshape(len(x), positions, size)
            found = [cells[i].nearest(parts[:, i]) for i in range(positions)]
            codes = np.stack([e for e, _ in found], 1).astype(np.uint8)
            error = np.sum([d for _, d in found], 0)
            columns = [rows.column("vec_id"), rows.column("label"), pa.array([c.tobytes().hex() for c in codes]), pa.array(error)]
            yield from pa.table(columns, names=["vec_id", "label", "code", "error"]).to_batches()

    return run


def trained(x: DataFrame, positions: int, entries: int, rounds: int, width: int, remembered: int) -> np.ndarray | None:
    """Codebooks (positions x entries x size) after some rounds over all rows of ``x``; None without rows."""
    least, most = x.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if least is None:
        return None
    if least != most or least % positions:
        raise ValueError(f"vectors of {least} to {most} components are not cut into {positions} equal parts")
    size = least // positions
    first = x.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    books = np.array([r["x"] for r in first], np.int64).reshape(len(first), positions, size).transpose(1, 0, 2).copy()
    names = [f"s{i}" for i in range(size)]
    schema = pa.schema([("position", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), *((n, pa.int64()) for n in names)])
    ddl = "position int, entry int, n long, " + ", ".join(f"{n} long" for n in names)
    for _ in range(rounds):
        partial = x.select("x").mapInArrow(task(_sums(books, width, remembered, schema)), ddl)
        sums = partial.groupBy("position", "entry").agg(*[F.sum(n).alias(n) for n in ("n", *names)])
        books = books.copy()
        for position, entry, n, *total in sums.collect():  # positions x entries rows
            books[position, entry] = [t // n for t in total]
    return books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal numbers by position, entry, place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def coded(
    vectors: DataFrame,
    positions: int = 16,
    entries: int = 64,
    rounds: int = 2,
    width: int = 24,
    remembered: int = 20_000,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for every row with a whole vector.

    ``entries``: at most 256. ``width``: side of a grid cell, in steps of 1/256. ``label_error``: errors of all rows
    with an equal label.
    """
    if not 1 <= entries <= 256:
        raise ValueError("1 to 256 entries")
    x = kept_vectors(vectors, id_column, vector_column, label_column)
    books = trained(x, positions, entries, rounds, width, remembered)
    if books is None:
        return x.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    kinds = T.StructType([x.schema["vec_id"], x.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    codes = written(x.mapInArrow(task(_coded(books, width, remembered)), kinds), "codes")
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    joined = codes.alias("c").join(sums.alias("s"), F.col("c.label").eqNullSafe(F.col("s.label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))

"""N-gram Jaccard self-join with multiple global token orders.

A document's tokens are its distinct shingles. Two documents whose similarity
reaches the threshold share a token among the first few (the prefix) of each, under
any order of all tokens. Several orders are used, and a candidate has to pass under
each. All of them put rare tokens first and differ in how they break ties, so that
passages known to many documents come last.

1. Lone documents. Half of all shingles, chosen by their hash, go to splits of the hash's
   range, whose number grows with the texts, and the shingles that one document alone
   holds are counted for it. A document with a whole prefix of them has no partner and
   is settled. Of the others 16 MiB of bits by row key are kept and broadcast; a
   settled document that falls on one of them only goes on with them.
2. Rarity. Every shingle of the documents that are left is counted into one of 2^28 cells.
   What is kept takes 36 MiB at any size of the corpus, and is broadcast: a bit for each
   cell that was hit twice or more, and 16 levels of the counts of 32 cells together. A
   shingle in a cell hit once has one occurrence: a document whose prefix holds nothing
   else is settled, too.
3. Documents with equal token sets become one class, which goes on as one.
4. Stars: a class is verified against one of those with which it shares a prefix token,
   the same one for all where it can be. This joins large groups of near copies without
   making their pairs.
5. The rest: classes that are not yet connected and share prefix tokens. Tokens with the
   same head form a family. In families of up to ``LARGE`` classes, all pairs that share
   prefix tokens under every order and fit in size and place are verified. Larger ones
   are cut into blocks; a block is compared with a block inside a task, which returns
   what got connected and not the pairs. Blocks of a family's main component are not
   compared with each other: how its classes are connected no longer matters.

Verification compares whole token sets (64-bit hashes). The result is exact: no link
between components is lost.

Defined results. A null text has no words; texts without words link with nothing.
Null ids count for nothing in component_id, which is null if a group has no other.
Repeated ids are documents of their own. An empty table gives no rows. Other columns
are ignored, or carried by ``kept_rows``, where rows that repeat id and text are one
document and stay or go together. The words of one document have to fit a task.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeed.llm.common import bucketed, components, lower_words, mixed, run_hashes, task, WordHashes, written

CELL_BITS, SLICE_BITS = 28, 20
ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
SHINGLES_AT_ONCE = 2_000_000
LEVEL_BITS = 5  # a level stands for 2^5 cells
SALTS, PARTS = 16, 16
SPLIT_BITS, SPLIT_BYTES = 26, 16 << 20  # of one split of the tokens: its cells and the texts it stands for
DOCUMENTS_AT_ONCE = 200_000
ROW_BITS, BUCKET_BYTES = 27, 4096  # of the bits by row key, and bytes of one of Spark's bitmaps
LARGE, BLOCK = 64, 200

PIECES = pa.schema([("split", pa.int32()), ("part", pa.int32()), ("held", pa.int64()), ("places", pa.binary()), ("numbers", pa.binary())])
PIECES_DDL = "split int, part int, held long, places binary, numbers binary"
COUNTS = pa.schema([("slice", pa.int32()), ("salt", pa.int32()), ("cells", pa.binary()), ("counts", pa.binary())])
COUNTS_DDL = "slice int, salt int, cells binary, counts binary"
LEVELS = pa.schema([("slice", pa.int32()), ("twice", pa.binary()), ("levels", pa.binary())])
TOKENS = pa.schema(
    [("doc_id", pa.int64()), ("row_key", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("set", pa.binary())]
    + [(f"order{k}", pa.list_(pa.int64())) for k in range(len(ORDERS))]
    + [("places", pa.list_(pa.int32()))]
)
TOKENS_DDL = "doc_id long, row_key long, n long, digest binary, set binary, " + ", ".join(f"order{k} array<long>" for k in range(len(ORDERS))) + ", places array<int>"
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_set(text: str | None, cache: WordHashes, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of all words together where they are fewer."""
    words = lower_words(text)
    return np.unique(run_hashes(cache.of(words), min(size, len(words)))) if words else np.empty(0, np.uint64)


def cells_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _packed(values: np.ndarray) -> bytes:
    """Small integers, byte plane by byte plane."""
    return zstandard.compress(np.ascontiguousarray(values, np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32)[:, 0]


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _alone(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted cells, which are the first of their kind and which the only one."""
    first = np.ones(len(cells), bool)
    first[1:] = cells[1:] != cells[:-1]
    return first, first & np.append(first[1:], True)


def _dealt(size: int, percent: int, splits: int):
    """Half of the tokens as rows of PIECES: by split, the places of those that some documents hold, and which of them where it is one (from 1, else 0).

    One more row, in a split of the part, has the row keys of these documents and their prefix sizes.
    """

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        shift = np.uint64(64 - SPLIT_BITS - (splits.bit_length() - 1))
        cache, held, keys, lengths, n = WordHashes(), [], [], [], 0

        def flush():
            # A number of its own for each attempt: pieces of two attempts are never added up.
            name = int.from_bytes(os.urandom(8), "little") >> 1
            yield _rows([(splits + part, part, name, np.array(keys, np.int64).tobytes(), _packed(np.array(lengths)))], PIECES)
            cells = np.concatenate(held)
            order = np.argsort(cells)
            owners = np.repeat(np.arange(1, len(held) + 1, dtype=np.uint32), [len(x) for x in held])[order]
            cells = cells[order]
            first, alone = _alone(cells)
            owners = np.where(alone, owners, 0)[first]
            cells = cells[first]
            edges = np.searchsorted(cells, np.arange(splits + 1, dtype=np.uint64) << np.uint64(SPLIT_BITS))
            rows = []
            for i, (a, b) in enumerate(zip(edges, edges[1:])):
                if b > a:
                    places = cells[a:b] & np.uint64((1 << SPLIT_BITS) - 1)
                    rows.append((i, part, name, _packed(np.diff(places, prepend=np.uint64(0))), _packed(owners[a:b])))
                if len(rows) == 256:
                    yield _rows(rows, PIECES)
                    rows = []
            if rows:
                yield _rows(rows, PIECES)

        for batch in batches:
            for row_key, text in zip(batch.column("row_key").to_pylist(), batch.column("text")):
                tokens = shingle_set(text.as_py(), cache, size)
                if len(tokens):
                    held.append(tokens[tokens & np.uint64(1) == 0] >> shift)
                    keys.append(row_key)
                    lengths.append(prefix_size(len(tokens), percent))
                    n += len(held[-1])
                    if n >= SHINGLES_AT_ONCE or len(held) >= DOCUMENTS_AT_ONCE:
                        yield from flush()
                        held, keys, lengths, n = [], [], [], 0
        if held:
            yield from flush()

    return run


def _told(splits: int):
    """Over rows sorted by split: for each row, the documents with tokens that no other one holds, and how many; rows of documents as they are."""

    def out(held: list[tuple]):
        cells, owners = (np.concatenate([x[i] for x in held]) for i in (2, 3))
        order = np.argsort(cells)
        only = np.zeros(len(cells), bool)
        only[order[_alone(cells[order])[1]]] = True
        only &= owners > 0
        rows, end = [], 0
        for part, name, places, _ in held:
            start, end = end, end + len(places)
            found, times = np.unique(owners[start:end][only[start:end]], return_counts=True)
            if len(found):
                rows.append((-1, part, name, _packed(np.diff(found - 1, prepend=np.uint32(0))), _packed(times)))
        return rows

    def run(batches):
        current, held = None, []
        for batch in batches:
            rows = []
            for split, part, name, places, numbers in zip(*(batch.column(c).to_pylist() for c in PIECES.names)):
                if split >= splits:
                    rows.append((split, part, name, places, numbers))
                    continue
                if split != current:
                    rows += out(held) if held else []
                    current, held = split, []
                held.append((part, name, np.cumsum(_unpacked(places), dtype=np.int64).astype(np.uint32), _unpacked(numbers)))
            if rows:
                yield _rows(rows, PIECES)
        if held and (rows := out(held)):
            yield _rows(rows, PIECES)

    return run


def _left(batches):
    """Over rows sorted by the name they were held under: row keys of documents with less than a prefix of tokens of their own."""

    def out(documents: tuple | None, found: list[tuple]):
        keys, lengths = np.frombuffer(documents[0], np.int64), _unpacked(documents[1])
        own = np.zeros(len(keys), np.int64)
        for places, times in found:
            own[np.cumsum(places, dtype=np.int64)] += times
        return pa.RecordBatch.from_arrays([pa.array(keys[own < lengths])], names=["row_key"])

    current, documents, found = None, None, []
    for batch in batches:
        for split, name, places, numbers in zip(*(batch.column(c).to_pylist() for c in ("split", "held", "places", "numbers"))):
            if name != current:
                if documents:
                    yield out(documents, found)
                current, documents, found = name, None, []
            if split < 0:
                found.append((_unpacked(places), _unpacked(numbers)))
            else:
                documents = places, numbers
    if documents:
        yield out(documents, found)


class Open:
    """Bits by row key of the documents that may have a partner. Any other document has none."""

    def __init__(self, bits: np.ndarray | None = None):
        self.bits = np.zeros(1 << (ROW_BITS - 3), np.uint8) if bits is None else bits

    def holds(self, row_keys: list[int]) -> np.ndarray:
        cells = (np.array(row_keys, np.int64).view(np.uint64) >> np.uint64(64 - ROW_BITS)).astype(np.int64)
        return (self.bits[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 > 0


def open_documents(source: DataFrame, size: int, percent: int) -> Open:
    """Documents that hold less than a prefix of tokens of their own. The tokens move once, in some 3.5 bytes each for half of them."""
    texts = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    splits = 16
    while splits * SPLIT_BYTES < texts:
        splits *= 2
    pieces = source.select("row_key", "text").mapInArrow(task(_dealt(size, percent, splits)), PIECES_DDL)
    told = pieces.repartition("split").sortWithinPartitions("split").mapInArrow(task(_told(splits)), PIECES_DDL)
    left = told.repartition("part").sortWithinPartitions("part", "held").mapInArrow(task(_left), "row_key long")
    place = F.shiftrightunsigned("row_key", 64 - ROW_BITS) + 1
    bits = left.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    out = Open()
    for row in bits.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        out.bits[(row["bucket"] - 1) * BUCKET_BYTES : row["bucket"] * BUCKET_BYTES] = np.frombuffer(row["bits"], np.uint8)
    return out


def _slices(cells: np.ndarray, counts: np.ndarray, salt: int) -> Iterator[tuple]:
    """Rows of COUNTS out of sorted cells; places count from the start of the slice."""
    edges = np.searchsorted(cells, np.arange(0, (1 << CELL_BITS) + 1, 1 << SLICE_BITS))
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        if b > a:
            yield i, salt, _packed(np.diff(cells[a:b], prepend=i << SLICE_BITS)), _packed(np.minimum(counts[a:b], 0xFFFFFFFF))


def _counted(size: int, left):
    def run(batches):
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() % SALTS
        cache, held, n, may = WordHashes(), [], 0, Open(left.value)

        def flush():
            cells, counts = np.unique(np.concatenate(held), return_counts=True)
            rows = list(_slices(cells, counts, salt))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), COUNTS)], schema=COUNTS)

        for batch in batches:
            for text in batch.column("text").filter(pa.array(may.holds(batch.column("row_key").to_pylist()))):
                cells = cells_of(shingle_set(text.as_py(), cache, size))
                if len(cells):
                    held.append(cells)
                    n += len(cells)
                    if n >= SHINGLES_AT_ONCE:
                        yield flush()
                        held, n = [], 0
        if held:
            yield flush()

    return run


def _summed(last: bool):
    """Over rows sorted by slice: one row for each slice, as counts or (``last``) as levels."""

    def out(index: int, total: np.ndarray):
        if not last:
            cells = np.flatnonzero(total)
            rows = [(index, 0, _packed(np.diff(cells, prepend=0)), _packed(np.minimum(total[cells], 0xFFFFFFFF)))]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), COUNTS)], schema=COUNTS)
        together = total.reshape(-1, 1 << LEVEL_BITS).sum(1)
        level = np.zeros(len(together), np.uint8)  # 1: one, 2: two or three, then by factors of four
        for i in range(15):
            level += together >= (1 if i == 0 else 2 * 4 ** (i - 1))
        columns = [[index], [np.packbits(total > 1, bitorder="little").tobytes()], [(level[::2] | level[1::2] << 4).tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, LEVELS)], schema=LEVELS)

    def run(batches):
        current, total = None, None
        for batch in batches:
            for index, cells, counts in zip(*(batch.column(n).to_pylist() for n in ("slice", "cells", "counts"))):
                if index != current:
                    if current is not None:
                        yield out(current, total)
                    current, total = index, np.zeros(1 << SLICE_BITS, np.int64)
                total[np.cumsum(_unpacked(cells), dtype=np.int64)] += _unpacked(counts)
        if current is not None:
            yield out(current, total)

    return run


class Rarity:
    """How rare the tokens of each cell are: 32 MiB of bits and 4 MiB of levels."""

    def __init__(self, twice: np.ndarray | None = None, levels: np.ndarray | None = None):
        self.twice = np.zeros(1 << (CELL_BITS - 3), np.uint8) if twice is None else twice
        self.levels = np.zeros(1 << (CELL_BITS - LEVEL_BITS - 1), np.uint8) if levels is None else levels

    def put(self, index: int, twice: bytes, levels: bytes) -> None:
        for target, data in ((self.twice, twice), (self.levels, levels)):
            target[index * len(data) : (index + 1) * len(data)] = np.frombuffer(data, np.uint8)

    def of(self, tokens: np.ndarray) -> np.ndarray:
        """0 for tokens that occur once among the documents counted, else 1 and more, the more the more frequent."""
        cells = cells_of(tokens)
        twice = (self.twice[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1
        groups = cells >> LEVEL_BITS
        level = (self.levels[groups >> 1] >> ((groups & 1) << 2).astype(np.uint8)) & 15
        return twice * level


def rarity(source: DataFrame, size: int, left) -> Rarity:
    """Of the tokens of the documents that ``left``, the broadcast bits of Open, holds."""
    counts = source.select("row_key", "text").mapInArrow(task(_counted(size, left)), COUNTS_DDL)
    by_salt = counts.repartition("slice", "salt").sortWithinPartitions("slice", "salt").mapInArrow(task(_summed(False)), COUNTS_DDL)
    rows = by_salt.repartition(PARTS, "slice").sortWithinPartitions("slice").mapInArrow(task(_summed(True)), "slice int, twice binary, levels binary")
    out = Rarity()
    for row in rows.toLocalIterator():  # 256 rows of 144 KiB at most, a part at a time
        out.put(row["slice"], row["twice"], row["levels"])
    return out


def prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _tokens(size: int, percent: int, left, known):
    def run(batches):
        cache, may, rare = WordHashes(), Open(left.value), Rarity(*known.value)
        for batch in batches:
            rows, row_keys = [], batch.column("row_key").to_pylist()
            for doc_id, row_key, text, there in zip(batch.column("doc_id").to_pylist(), row_keys, batch.column("text"), may.holds(row_keys)):
                tokens = shingle_set(text.as_py(), cache, size)
                n, row = len(tokens), (doc_id, row_key, len(tokens))
                length = prefix_size(n, percent)
                if not n or not there or ((level := rare.of(tokens)) == 0).sum() >= length:
                    rows.append((*row, *[None] * (len(ORDERS) + 3)))
                    continue
                orders, place_in_first = [], None
                for seed in ORDERS:
                    rank = level.astype(np.uint64) << np.uint64(60) | mixed(tokens ^ np.uint64(seed)) >> np.uint64(4)
                    first = np.argsort(rank)[:length]
                    places = np.flatnonzero(level[first])
                    orders.append(tokens[first[places]].view(np.int64))
                    place_in_first = places if place_in_first is None else place_in_first
                data = tokens.tobytes()
                rows.append((*row, hashlib.blake2b(data, digest_size=16).digest(), data, *orders, place_in_first))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), TOKENS)], schema=TOKENS)

    return run


def _verified(percent: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            left, right = [], []
            for i, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    left.append(a[i])
                    right.append(b[i])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], schema=LINKS)

    return run


def verified(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that reach the threshold.

    ``classes`` lies in buckets of its nodes, so only the pairs move to find the sets of
    a. Many pairs may share b; their sets move to those of b, where a skewed join is split.
    """
    left = pairs.join(classes.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
    needed = pairs.select(F.col("b").alias("node")).distinct()
    right = classes.select("node", "set").join(needed, "node", "left_semi").select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    return left.join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(task(_verified(percent)), "a long, b long")


def fits(n: str, m: str, percent: int) -> Column:
    """Whether sets of these sizes can reach the threshold."""
    return F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)


def smallest_overlap(percent: int) -> Column:
    """Common tokens that sets of n and m need to reach the threshold."""
    return F.expr(f"({percent}L * (n + m) + {99 + percent}L) div {100 + percent}L")


def star_pairs(classes: DataFrame, percent: int, seed: int) -> DataFrame:
    """a, b: each class with one class b that heads one of its prefix tokens and fits in size and place."""
    tokens = classes.select("node", "n", F.explode(F.arrays_zip("order0", "places")).alias("t")).select("node", "n", "t.order0", "t.places")
    head = F.struct(F.xxhash64(F.lit(seed), "node").alias("at"), F.col("node").alias("head"), F.col("n").alias("m"), F.col("places").alias("place"))
    heads = tokens.groupBy("order0").agg(F.min(head).alias("h"), F.count("*").alias("times")).where("times > 1")
    near = tokens.join(heads.select("order0", "h.*"), "order0").where("node <> head").where(fits("n", "m", percent))
    near = near.where(F.least(F.col("n") - F.col("places"), F.col("m") - F.col("place")) >= smallest_overlap(percent))
    return near.groupBy("node").agg(F.min(F.struct("at", "head")).alias("h")).select(F.col("node").alias("a"), F.col("h.head").alias("b"))


def open_families(classes: DataFrame, joined: DataFrame) -> DataFrame:
    """node, n, group, token, place, head, large: prefix tokens shared by classes not yet connected."""
    group = F.coalesce("component", F.col("c.node")).alias("group")
    tokens = classes.alias("c").join(joined.alias("j"), F.col("c.node") == F.col("j.node"), "left")
    tokens = tokens.select("c.node", "n", group, F.explode(F.arrays_zip("order0", "places")).alias("t"))
    tokens = tokens.select("node", "n", "group", F.col("t.order0").alias("token"), F.col("t.places").alias("place"))
    first = F.min(F.struct(F.xxhash64("node").alias("at"), "node")).alias("first")
    shared = tokens.groupBy("token").agg(first, F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high")
    heads = written(shared.select("token", F.col("first.node").alias("head")), "heads")
    members = written(tokens.join(heads, "token"), "members")
    sizes = members.select("head", "node").distinct().groupBy("head").agg((F.count("*") > LARGE).alias("large"))
    return members.join(written(sizes, "families"), "head")


def remaining_pairs(families: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """a, b: classes not yet connected that pass the filters of all orders, from families that are not large."""
    tokens = families.where("not large")
    x = tokens.select("token", F.col("node").alias("a"), "n", F.col("group").alias("group_a"), F.col("place").alias("place_a"))
    y = tokens.select("token", F.col("node").alias("b"), F.col("n").alias("m"), F.col("group").alias("group_b"), F.col("place").alias("place_b"))
    pairs = x.join(y, "token").where("a > b AND group_a <> group_b").where(fits("n", "m", percent))
    # Of the first token that two documents share, no more can follow than the shorter rest.
    pairs = pairs.where(F.least(F.col("n") - F.col("place_a"), F.col("m") - F.col("place_b")) >= smallest_overlap(percent))
    pairs = pairs.select("a", "b").distinct()
    others = [f"order{k}" for k in range(1, len(ORDERS))]
    for end in "ab":
        arrays = classes.select(F.col("node").alias(end), *[F.col(o).alias(f"{o}_{end}") for o in others])
        pairs = pairs.join(arrays, end)
    for o in others:
        pairs = pairs.where(F.arrays_overlap(f"{o}_a", f"{o}_b"))
    return pairs.select("a", "b")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set on the left with each on the right."""
    tokens = np.concatenate(left + right)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in left + right])
    _, column, times = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times[column] > 1)
    column, owner = np.unique(column[shared], return_inverse=True)[1], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        there = np.zeros((len(left) + len(right), width), np.float32)
        there[owner[a:b], column[a:b] - low] = 1
        out += there[: len(left)] @ there[len(left) :].T
    return out.astype(np.int64)


def _compared(percent: int):
    """Over pairs of blocks: (node, smallest node connected to it within the two blocks)."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = batch.column("members_a")[i].as_py(), batch.column("members_b")[i].as_py()
                sets = [[np.frombuffer(m["set"], np.uint64) for m in side] for side in (a, b)]
                sizes = [np.array([len(x) for x in side]) for side in sets]
                both = overlaps(*sets)
                links = 100 * both >= percent * (sizes[0][:, None] + sizes[1][None, :] - both)
                nodes = [np.array([m["node"] for m in side], np.int64) for side in (a, b)]
                labels, biggest = list(nodes), np.iinfo(np.int64).max
                while True:
                    first = np.minimum(labels[0], np.where(links, labels[1][None, :], biggest).min(1))
                    second = np.minimum(labels[1], np.where(links, first[:, None], biggest).min(0))
                    if (first == labels[0]).all() and (second == labels[1]).all():
                        break
                    labels = [first, second]
                node, label = np.concatenate(nodes), np.concatenate(labels)
                moved = node != label
                yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(label[moved])], schema=LINKS)

    return run


def block_links(families: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """a, b: what large families connect."""
    members = families.where("large").select("head", "node", "group").distinct()
    mains = members.groupBy("head", "group").agg(F.count("*").alias("n")).groupBy("head").agg(F.max(F.struct("n", "group")).alias("main"))
    members = members.join(mains, "head").select("head", "node", (F.col("group") == F.col("main.group")).alias("main"))
    sizes = members.groupBy("head", "main").agg(F.count("*").alias("n"))
    members = members.join(sizes, ["head", "main"]).withColumn("block", F.pmod(F.xxhash64(F.lit(3), "node"), F.ceil(F.col("n") / BLOCK)))
    filled = members.select("head", "main", "block", "node").join(classes.select("node", "set"), "node")
    blocks = written(filled.groupBy("head", "main", "block").agg(F.collect_list(F.struct("node", "set")).alias("members")), "blocks")
    a = blocks.withColumnsRenamed({c: f"{c}_a" for c in ("main", "block", "members")})
    b = blocks.withColumnsRenamed({c: f"{c}_b" for c in ("main", "block", "members")})
    pairs = a.join(b, "head").where("NOT main_a AND (main_b OR block_a <= block_b)")
    return pairs.select("members_a", "members_b").mapInArrow(task(_compared(percent)), "a long, b long")


def grouped(docs: DataFrame, shingle: int = 4, percent: int = 85, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, row_key, n_shingles, component_id, first (whether the row is the one that stays) for every row."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    source = source.withColumn("row_key", F.xxhash64("doc_id", "text"))
    left = spark.sparkContext.broadcast(open_documents(source, shingle, percent).bits)
    counted = rarity(source, shingle, left)
    known = spark.sparkContext.broadcast((counted.twice, counted.levels))
    del counted
    tokens = written(source.mapInArrow(task(_tokens(shingle, percent, left, known)), TOKENS_DDL), "tokens")
    known.destroy()
    left.destroy()

    # One row for each distinct set. Null ids come last; the row key breaks ties.
    active = tokens.where("digest is not null").withColumn("node", F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("least")
    wide = ["digest", "n", "set", "places", *[f"order{k}" for k in range(len(ORDERS))]]
    classes = bucketed(active.groupBy("node").agg(least, *[F.any_value(c).alias(c) for c in wide]), "node", "classes")

    stars = written(star_pairs(classes, percent, 1).union(star_pairs(classes, percent, 2)).distinct(), "stars")
    links = written(verified(stars, classes, percent), "links")
    joined = components(links, "joined")
    families = open_families(classes, joined)
    rest = written(remaining_pairs(families, classes, percent), "rest")
    found = verified(rest, classes, percent).union(block_links(families, classes, percent))
    joined = components(links.union(written(found, "links")), "joined")

    narrow = classes.select("node", "least").join(joined, "node", "left")
    narrow = narrow.select("node", "least", F.coalesce("component", "node").alias("component"))
    groups = narrow.groupBy("component").agg(F.min("least").alias("stays"))
    answers = written(narrow.join(groups, "component").select("node", "stays"), "answers")
    paired = active.select("node", "doc_id", "row_key", "n").join(answers, "node")
    paired = paired.select("doc_id", "row_key", "n", F.col("stays.doc_id").alias("component_id"), (F.col("row_key") == F.col("stays.row_key")).alias("first"))
    alone = tokens.where("digest is null").select("doc_id", "row_key", "n", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return paired.union(alone).withColumnRenamed("n", "n_shingles")


def kept_rows(docs: DataFrame, shingle: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of one document of each group, that with the smallest id, with all their columns."""
    gone = grouped(docs, shingle, percent, id_column, text_column).where("not first").select(F.col("row_key").alias("_gone")).distinct()
    key = F.xxhash64(F.col(id_column).cast("long"), F.col(text_column).cast("string"))
    return docs.join(gone, key == gone["_gone"], "left_anti")

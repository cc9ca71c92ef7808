"""Language-model scores from a log-frequency Bloom filter.

A filter holds the word pairs of the training documents with their counts on a
logarithmic scale: a pair of level k is stored k times, as (pair, 1) to (pair, k), and
its count is read back by probing until a probe fails. The probability of a word is
its share after the word before, smoothed towards its share in the corpus with a
Dirichlet prior: (c(v, w) + prior * p(w)) / (c(v) + prior). c(v, w) is read as at most c(v)
and c(w), so that no probability exceeds 1; c(v) is exact, so the shares after a frequent
v may miss 1 by the width of a level.

1. Texts are read and cut into words once. A task deals its texts into blocks of about
   ``block_bytes`` and stores each: its words as numbers of the block's own vocabulary, and its
   distinct words and pairs as sorted hashes in slices by hash, with their counts in
   training texts.
2. The blocks' counts are merged slice by slice. Each slice becomes a table of exact word
   counts and a piece of the filter of its own size.
3. The filter is broadcast in parts, stretches of slices of about ``part_bytes``. Stored pairs lie
   in a folder for each part, so a part probes the pairs that fall to it and no others: the
   parts together probe each block's pairs once, however many they are.
4. Exact word counts are unbounded and never broadcast: they come by a join on the slice.
5. A block's numbers meet the counts of its words and the levels of its pairs, and give
   the scores of its documents.

Words are told apart by 64-bit hashes. Every document takes part, with its whole text.

Defined results. A null text is empty and has one token, its end. A null doc_id counts
as empty text when documents are held out. Without any training token, scores follow
from add-one counts of nothing. Rows that repeat are scored alike, each for itself.
An empty table gives no rows. Other columns are ignored. The words of one document
have to fit a task's memory. Rows that repeat lie in the blocks of the tasks that read them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfeed.llm.common import lower_words, mixed, octets, shared_path, task, written

END = np.uint64(0x5BD1E9955BD1E995)  # stands for the end of a text, and for what is before its start
PAIR = np.uint64(0x9E3779B97F4A7C15)
# Smallest count of each level: factors of about 1.1.
STEPS = np.unique(np.round(1.1 ** np.arange(460)).astype(np.uint64))
MIDDLES = np.append(0, (STEPS[:-1] + STEPS[1:] - 1) / 2)
BITS_PER_ENTRY, PROBES = 8, 5

BLOCKS = pa.schema([
    ("part", pa.int32()), ("slice", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int64())), ("numbers", pa.binary()), ("words", pa.binary()),
])
BLOCKS_DDL = (
    "part int, slice int, block long, keys binary, counts binary, "
    "doc_ids array<long>, held array<boolean>, lengths array<long>, numbers binary, words binary"
)
WORDS, TEXTS = -1, -2  # in place of a part of the filter
PIECES = pa.schema([("slice", pa.int32()), ("pairs", pa.bool_()), ("keys", pa.binary()), ("counts", pa.binary()), ("distinct", pa.int64()), ("total", pa.int64())])
PIECES_DDL = "slice int, pairs boolean, keys binary, counts binary, distinct long, total long"
GIVEN = pa.schema([("block", pa.int64()), ("pairs", pa.bool_()), ("slice", pa.int32()), ("counts", pa.binary())])
GIVEN_DDL = "block long, pairs boolean, slice int, counts binary"
SCORED = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("known_logs", pa.float64()), ("score", pa.float64()),
])
SCORED_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, known_logs double, score double"


class BlockWords(dict):
    """The distinct words of a block, numbered as they come; 0 is the end."""

    def __init__(self):
        super().__init__()
        self.hashes = [int(END)]

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return number

    def numbers(self, text: str | None) -> np.ndarray:
        words = lower_words(text)
        out = np.zeros(len(words) + 1, np.int64)
        out[:-1] = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return out


def pair_keys(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """A hash of 48 bits for each token with the one before; the filter confuses more pairs than that."""
    return mixed(before * PAIR + tokens) & np.uint64(0xFFFFFFFFFFFF0000)


def packed(values: np.ndarray) -> bytes:
    """64-bit integers, byte plane by byte plane; sorted ones as differences before."""
    return zstandard.compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(np.int64)[:, 0]


def packed_keys(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data).view(np.uint64), dtype=np.uint64)


def slice_of(keys: np.ndarray, slices: int) -> np.ndarray:
    """Slices are stretches of the keys' range, so sorted keys are sorted by slice."""
    return ((keys >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)


def by_slice(keys: np.ndarray, slices: int) -> Iterator[tuple[int, int, int]]:
    """(slice, from, to) of sorted keys."""
    edges = np.searchsorted(slice_of(keys, slices), np.arange(slices + 1))
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        if b > a:
            yield i, a, b


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def block_pairs(hashes: np.ndarray, numbers: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number before, hash of the pair) of each token of a block; a text follows an end."""
    before = np.roll(numbers, 1)
    before[starts] = 0
    return before, pair_keys(hashes[before], hashes[numbers])


def counted(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often they occur in training; the keys' lowest bit is free."""
    marked = np.sort(keys | train.astype(np.uint64))
    keys = marked & np.uint64(0xFFFFFFFFFFFFFFFE)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat((marked & np.uint64(1)).astype(np.int64), first)


def _blocks(slices: int, part_slices: int, block_bytes: int):
    def run(batches):
        here, block = TaskContext.get().partitionId(), 0
        words, held, size = BlockWords(), [], 0

        def filled(values: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in BLOCKS], schema=BLOCKS)

        def flush():
            name, hashes = here << 24 | block, np.array(words.hashes, np.uint64)
            lengths = np.array([len(n) for *_, n in held], np.int64)
            numbers, train = np.concatenate([n for *_, n in held]), np.repeat(~np.array([h for _, h, _ in held], bool), lengths)
            starts = np.cumsum(lengths) - lengths
            yield filled({
                "part": TEXTS, "slice": 0, "block": name, "doc_ids": [i for i, *_ in held], "held": [h for _, h, _ in held],
                "lengths": lengths, "numbers": packed(numbers), "words": packed(hashes.view(np.int64)),
            })
            order = np.argsort(hashes)
            found = {True: counted(block_pairs(hashes, numbers, starts)[1], train), False: (hashes[order], np.bincount(numbers[train], minlength=len(hashes))[order])}
            for pairs, (keys, counts) in found.items():
                for i, a, b in by_slice(keys, slices):
                    part = i // part_slices if pairs else WORDS
                    yield filled({"part": part, "slice": i, "block": name, "keys": packed_keys(keys[a:b]), "counts": packed(counts[a:b])})

        for batch in batches:
            for doc_id, out, text in zip(*(batch.column(i).to_pylist() for i in range(2)), batch.column(2)):
                held.append((doc_id, out, words.numbers(text.as_py())))
                size += 8 * len(held[-1][2])  # of memory, as much as of text in most tongues
                if size >= block_bytes:
                    yield from flush()
                    words, held, size, block = BlockWords(), [], 0, block + 1
        if held:
            yield from flush()

    return run


def probe_places(keys: np.ndarray, level: int, bits: int | np.ndarray) -> Iterator[np.ndarray]:
    """The bits that (key, level) sets, one for each probe; bits: of the filter, under 2^32."""
    first = mixed(keys + np.uint64(level * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))
    step = first * PAIR | np.uint64(1)
    bits, half = np.asarray(bits, np.uint64), np.uint64(32)
    for i in range(PROBES):
        yield ((first + np.uint64(i) * step) >> half) * bits >> half


def bloom_piece(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """The filter of a slice: BITS_PER_ENTRY bits for each level of each key."""
    levels = np.searchsorted(STEPS, counts.astype(np.uint64), side="right")
    entries = max(1, int(levels.sum()))
    bits = -(-entries * BITS_PER_ENTRY // 64) * 64
    piece = np.zeros(bits, bool)
    order = np.argsort(-levels, kind="stable")
    keys, ends = keys[order], np.searchsorted(-levels[order], -np.arange(levels.max(initial=0) + 1), side="right")
    for level in range(1, int(levels.max(initial=0)) + 1):
        for place in probe_places(keys[: ends[level]], level, bits):
            piece[place.astype(np.int64)] = True
    return np.packbits(piece, bitorder="little").tobytes()


def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in held])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], np.concatenate([c for _, c in held])[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _pieces(batches):
    """Over rows sorted by slice and kind: word counts as they are, pairs as a piece of the filter."""

    def out(at: tuple[int, bool], held):
        keys, counts = merged(held)
        keys, counts = keys[counts > 0], counts[counts > 0]  # the others occur in texts held out
        total = int(counts.sum())
        if at[1]:
            return batch_of([(*at, bloom_piece(keys, counts), None, len(keys), total)], PIECES)
        return batch_of([(*at, packed_keys(keys), packed(counts), len(keys), total)], PIECES)

    current, held, size = None, [], 0
    for batch in batches:
        for i, kind, keys, counts in zip(*(batch.column(n).to_pylist() for n in ("slice", "pairs", "keys", "counts"))):
            if (i, kind) != current:
                if held:
                    yield out(current, held)
                current, held, size = (i, kind), [], 0
            held.append((unpacked_keys(keys), unpacked(counts)))
            size += len(held[-1][0])
            if size > 4_000_000:  # combine as they come, so that a slice takes the room of its distinct keys
                held = [merged(held)]
                size = len(held[0][0]) // 2
    if held:
        yield out(current, held)


class CountFilter:
    """Counts of pairs, read from the pieces of the slices from ``low`` to ``high``."""

    def __init__(self, slices: int, low: int, high: int, pieces: dict[int, bytes]):
        self.slices, self.low, self.high = slices, low, high
        sizes = np.array([len(pieces.get(i, b"")) for i in range(slices)], np.int64)
        self.bits, self.start = sizes.astype(np.uint64) * np.uint64(8), np.cumsum(sizes) - sizes
        self.data = np.frombuffer(b"".join(pieces[i] for i in sorted(pieces)), np.uint8)

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """The middle of the last level found; 0 for pairs that are not there."""
        return MIDDLES[self.levels(keys)]

    def levels(self, keys: np.ndarray) -> np.ndarray:
        at = slice_of(keys, self.slices)
        bits, start = self.bits[at], self.start[at]
        level = np.zeros(len(keys), np.int64)
        alive, step = np.flatnonzero(bits > 0), 1
        while len(alive) and step < len(MIDDLES):
            found = np.arange(len(alive))
            for place in probe_places(keys[alive], step, bits[alive]):
                place = place[found].astype(np.int64)
                byte = self.data[start[alive[found]] + (place >> 3)]
                found = found[(byte >> (place & 7).astype(np.uint8)) & 1 > 0]
            alive = alive[found]
            level[alive] = step
            step += 1
        return level


def lookup(keys: np.ndarray, counts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Counts of the wanted keys, 0 where they are missing; keys are sorted."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, counts[at], 0)


def _given(key, asked, known):
    """Word counts for each block that asks, in the order it asks in."""
    keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    if known.num_rows:
        keys, counts = unpacked_keys(known.column("keys")[0].as_py()), unpacked(known.column("counts")[0].as_py())
    rows = [
        (block, False, at, packed(lookup(keys, counts, unpacked_keys(wanted.as_py()))))
        for block, at, wanted in zip(asked.column("block").to_pylist(), asked.column("slice").to_pylist(), asked.column("keys"))
    ]
    return pa.Table.from_batches([batch_of(rows, GIVEN)]) if rows else GIVEN.empty_table()


def _probed(part):
    """Levels of each block's pairs, in the order of the pairs."""

    def run(batches):
        known = CountFilter(*part.value)
        for batch in batches:
            for block, at, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                yield batch_of([(block, True, at, packed(known.levels(unpacked_keys(keys.as_py()))))], GIVEN)

    return run


def _scored(tokens: int, distinct: int, prior: float):
    def run(key, texts, given):
        found = {}
        for pairs in (False, True):  # slices are stretches of the sorted keys
            rows = sorted((at, c) for p, at, c in zip(*(given.column(n).to_pylist() for n in ("pairs", "slice", "counts"))) if p == pairs)
            found[pairs] = np.concatenate([unpacked(c) for _, c in rows])
        row = {n: texts.column(n)[0] for n in ("doc_ids", "held", "lengths", "numbers", "words")}
        hashes, numbers = unpacked(row["words"].as_py()).view(np.uint64), unpacked(row["numbers"].as_py())
        lengths = np.array(row["lengths"].as_py(), np.int64)
        starts = np.cumsum(lengths) - lengths
        count_of = np.empty(len(hashes), np.int64)
        count_of[np.argsort(hashes)] = found[False]
        before, pairs = block_pairs(hashes, numbers, starts)
        distinct_pairs, back = np.unique(pairs, return_inverse=True)
        assert len(distinct_pairs) == len(found[True])
        # A pair is counted no more often than either of its words, whatever its level says; each training text has one end.
        times = count_of[before]
        read = np.minimum(MIDDLES[found[True]][back], np.minimum(times, count_of[numbers]))
        share = prior * (count_of + 1) / (tokens + distinct + 1)
        logs = np.log10((read + share[numbers]) / (times + prior))
        sums = [np.add.reduceat(x, starts) for x in ((count_of > 0).astype(np.int64)[numbers], np.log10(count_of + 1.0)[numbers], logs)]
        columns = [row["doc_ids"].as_py(), row["held"].as_py(), lengths, *sums]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCORED)], schema=SCORED)

    return run


def language_scores(
    docs: DataFrame,
    prior: float = 300.0,
    fold: int = 7,
    held_fold: int = 2,
    block_bytes: int = 16 << 20,
    slice_bytes: int = 12 << 20,
    part_bytes: int = 64 << 20,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Documents whose CRC-32 of the id leaves ``held_fold`` modulo ``fold`` are not learned from.
    ``slice_bytes``: bytes of text for each slice of the counts. ``part_bytes``: of the filter that
    workers hold at once; stretches of slices are laid out for it by their bytes of text, and
    sent in several pieces where they come out larger.
    """
    spark = docs.sparkSession
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    source = source.select("doc_id", (F.pmod(F.crc32(name), F.lit(fold)) == held_fold).alias("held_out"), "text")
    size = source.agg(F.sum(octets("text"))).first()[0] or 0
    slices = 1 + size // slice_bytes
    part_slices = max(1, 6 * part_bytes // slice_bytes)  # a filter takes a sixth of its text or less

    path = shared_path(spark, "lm-blocks")
    blocks = source.mapInArrow(task(_blocks(slices, part_slices, block_bytes)), BLOCKS_DDL)
    blocks.write.partitionBy("part").parquet(path)
    stored = spark.read.schema(blocks.schema).parquet(path)

    keys = stored.where(F.col("part") != TEXTS).select("slice", (F.col("part") != WORDS).alias("pairs"), "keys", "counts")
    sliced = keys.repartition("slice").sortWithinPartitions("slice", "pairs")
    pieces = written(sliced.mapInArrow(task(_pieces), PIECES_DDL), "lm-counts")
    totals = pieces.where("not pairs").agg(F.sum("distinct"), F.sum("total")).first()
    distinct, tokens = totals[0] or 0, totals[1] or 0

    asked = stored.where(F.col("part") == WORDS).select("slice", "block", "keys")
    known = pieces.where("not pairs").select("slice", "keys", "counts")
    counted_words = asked.groupBy("slice").cogroup(known.groupBy("slice")).applyInArrow(_given, GIVEN_DDL)
    counts_path = shared_path(spark, "lm-given")
    counted_words.write.parquet(counts_path)

    sizes = {r["slice"]: r["size"] for r in pieces.where("pairs").select("slice", F.octet_length("keys").alias("size")).collect()}
    edges, held = [0], 0
    for i in range(slices):
        if i % part_slices == 0 and i or held and held + sizes.get(i, 0) > part_bytes:
            edges.append(i)
            held = 0
        held += sizes.get(i, 0)
    for low, high in zip(edges, [*edges[1:], slices]):
        rows = pieces.where(F.col("pairs") & F.col("slice").between(low, high - 1)).select("slice", "keys").toLocalIterator()
        part = spark.sparkContext.broadcast((slices, low, high, {r["slice"]: bytes(r["keys"]) for r in rows}))
        own = stored.where((F.col("part") == low // part_slices) & F.col("slice").between(low, high - 1)).select("block", "slice", "keys")
        own.mapInArrow(task(_probed(part)), GIVEN_DDL).write.mode("append").parquet(counts_path)
        part.destroy()

    given = spark.read.schema(counted_words.schema).parquet(counts_path)
    texts = stored.where(F.col("part") == TEXTS).select("block", "doc_ids", "held", "lengths", "numbers", "words")
    scores = texts.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(_scored(tokens, distinct, prior), SCORED_DDL)
    base = F.col("known_logs") - F.col("n_tokens") * F.log10(F.lit(float(tokens + distinct + 1)))
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score")

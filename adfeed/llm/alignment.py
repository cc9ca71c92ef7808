"""Two tokenizers' tokens of the same bytes, linked where they overlap and counted over the corpus.

Tokenizer A reads a space and the text, tokenizer B the text, to which it adds the space itself.
Both cut the same bytes. Offsets where both end a token part them into groups; two tokens whose
byte ranges overlap are a link. A pair of ids counts in how many documents it is linked.

Pair-document records are counted outside of memory:

1. A task collects the links of some documents, sorts them by (A id, B id, document) and
   spills them as a run: one piece for each of ``parts`` residues of the A id, in zstandard
   frames. A piece holds its distinct pairs with their numbers of documents apart from the
   records (document, times) themselves.
2. Runs of pairs are merged part by part, some ``FAN`` at a time, in as many levels as that
   takes, each by a heap over the last pairs of their frames. One frame of each run is open. The
   last level meets the pairs of an A id one after another (side-major order), so the
   highest count of each A id is known as soon as it has passed.
3. Records meet the counts of their part in groups of about ``FAN`` / 2 runs. Pairs and records
   of a run stream by once more, and each piece sends back two sums for each of its documents.
   The pieces' sums are added run by run and joined to the documents.

A frequent id makes its part longer, not its groups: those hold a like number of runs at any
size, and a run a fixed number of links (or one document). What one task holds of the counts is bounded by
the vocabularies, whatever the corpus. Runs carry the number of the task that wrote them and lie
in a stored table, so later steps don't depend on executors that took part.

Defined results. Texts that are null or empty have no tokens: zeros and an empty string. The same
holds where the joined bytes of either tokenizer differ from the space and the text, which
is so for texts that spell U+2581. Special tokens' strings in a text are plain text. Null and
repeated doc_ids and repeated rows are documents of their own. An empty table gives no rows.
Other columns are ignored, also those named like the results. The links of one document have
to fit a task's memory.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfeed.llm.common import task, written
from adfeed.llm.packing import GAP, OTHER, worker_object

SIDE_A, SIDE_B = "byte_bpe_50k", "piece_bpe_32k"
B_BITS, DOC_BITS = np.uint64(24), np.uint64(16)
DOCUMENTS = 1 << 16  # of one run
LINKS = 2_000_000  # of one run
FRAME = 8192  # pairs
FAN = 64  # runs that one group holds
AT_ONCE = 1 << 19  # bytes of text

RUNS = pa.schema([
    ("run", pa.int64()), ("part", pa.int32()), *((n, pa.list_(pa.binary())) for n in ("pairs", "counts", "docs", "times")),
    ("doc", pa.int32()), ("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()),
])
RUNS_DDL = (
    "run long, part int, pairs array<binary>, counts array<binary>, docs array<binary>, times array<binary>, "
    "doc int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
)
MERGED = pa.schema([("run", pa.int64()), ("part", pa.int32()), *((n, pa.list_(pa.binary())) for n in ("pairs", "counts", "best"))])
MERGED_DDL = "run long, part int, pairs array<binary>, counts array<binary>, best array<binary>"
SUMS = pa.schema([("run", pa.int64()), ("count_sum", pa.binary()), ("n_best", pa.binary())])
SUMS_DDL = "run long, count_sum binary, n_best binary"
ALIGNED = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [("groups_sha256", pa.string())])
ALIGNED_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def pressed(values: np.ndarray) -> bytes:
    """Non-negative integers in the fewest bytes each, byte plane by byte plane."""
    values = np.asarray(values, np.uint64)
    size = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes()
    return bytes([size]) + zstandard.compress(planes, 1)


def unpressed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view(np.uint64)[:, 0]


def pressed_pairs(pairs: np.ndarray) -> bytes:
    return pressed(np.diff(pairs, prepend=np.uint64(0)))


def unpressed_pairs(data: bytes) -> np.ndarray:
    return np.cumsum(unpressed(data), dtype=np.uint64)


class Sides:
    """Both tokenizers, the bytes of their ids, and the pieces that groups are written with."""

    def __init__(self, side_a: str, side_b: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{side_a}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        def whole():
            tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{side_a}.json"))
            tokenizer.encode_special_tokens = True
            return tokenizer

        self.slow: Callable = lambda: worker_object(f"plain_{side_a}", whole)
        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{side_b}.model"))
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            self.bytes_a[i] = piece
        self.bytes_b = [self._piece(i) for i in range(self.model.vocab_size())]
        self.length_a, self.length_b = (np.array([len(p) for p in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        # id and what follows it: "," inside a side, "|" after side A, ";" after a group
        self.written = [b"%d%c" % (i, c) for ids, ends in ((len(self.bytes_a), b",|"), (len(self.bytes_b), b",;")) for i in range(ids) for c in ends]

    def _piece(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def ids_a(self, text: str) -> list[int]:
        """As ``tokenizers`` gives them; plain Latin characters take a shorter way to the same ids."""
        if not text.isascii() and OTHER.search(text) or GAP.search(text):
            return self.slow().encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def tokens(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both sides; none where their bytes are not the space and the text."""
        if not text:
            return [], []
        a, b, whole = self.ids_a(" " + text), self.model.encode(text), b" " + text.encode()
        same = b"".join(map(self.bytes_a.__getitem__, a)) == whole == b"".join(map(self.bytes_b.__getitem__, b))
        return (a, b) if same else ([], [])


def sides(side_a: str, side_b: str) -> Sides:
    return worker_object(f"sides_{side_a}_{side_b}", lambda: Sides(side_a, side_b))


class Aligned:
    """Links and groups of some documents, one after another."""

    def __init__(self, both: Sides, tokens: list[tuple[list[int], list[int]]]):
        a, b = (np.fromiter(itertools.chain.from_iterable(side), np.int64) for side in zip(*tokens))
        self.n_a, self.n_b = (np.array([len(ids) for ids in side], np.int64) for side in zip(*tokens))
        ends_a, ends_b = np.cumsum(both.length_a[a]), np.cumsum(both.length_b[b])
        last = np.cumsum(self.n_a) - 1  # of each document's A tokens; documents without any end where the one before does
        doc_ends = np.where(last >= 0, np.append(ends_a, 0)[last], 0)
        ends = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        self.a, self.b, self.doc = a[at_a], b[at_b], np.searchsorted(doc_ends, ends)
        self.n_links = np.bincount(self.doc, minlength=len(tokens))
        self.n_groups = self.n_a + self.n_b - self.n_links  # as many ends as both sides share
        # Tokens in the order of the groups, side A first.
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        until_a, until_b = np.searchsorted(ends_a, shared, "right"), np.searchsorted(ends_b, shared, "right")
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.append(0, until_b)[group_a]] = 2 * a + (ends_a == shared[group_a])
        order[np.arange(len(b)) + until_a[group_b]] = 2 * (len(both.bytes_a) + b) + (ends_b == shared[group_b])
        edges = np.cumsum(np.append(0, self.n_a + self.n_b)).tolist()
        get = both.written.__getitem__
        groups = (b"".join(map(get, order[s:e].tolist()))[:-1] for s, e in zip(edges, edges[1:]))
        self.digests = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]


def side_keys(a: np.ndarray, parts: int, width: int) -> np.ndarray:
    """A ids with the residue in front, so that sorted keys lie part by part."""
    return (a % parts * width + a // parts).astype(np.uint64)


def frames(values: list[np.ndarray], edges: np.ndarray, press: list[Callable]) -> list[list[bytes]]:
    return [[p(v[s:e]) for s, e in zip(edges, edges[1:])] for v, p in zip(values, press)]


def spilled(a: np.ndarray, b: np.ndarray, doc: np.ndarray, parts: int, width: int) -> Iterator[tuple]:
    """(part, pairs, counts, docs, times) in frames: the links of a run, sorted by side, pair and document."""
    keys = ((side_keys(a, parts, width) << B_BITS | b.astype(np.uint64)) << DOC_BITS) | doc.astype(np.uint64)
    records, times = np.unique(keys, return_counts=True)
    all_pairs = records >> DOC_BITS
    first = np.flatnonzero(np.concatenate([[True], all_pairs[1:] != all_pairs[:-1]]))
    pairs, docs = all_pairs[first], records & np.uint64(DOCUMENTS - 1)
    first = np.append(first, len(records))
    edges = np.searchsorted(pairs, (np.arange(parts + 1) * width).astype(np.uint64) << B_BITS)
    for part, (s, e) in enumerate(zip(edges, edges[1:])):
        if e > s:
            cuts = np.append(np.arange(s, e, FRAME), e)
            heads = frames([pairs, np.diff(first)], cuts, [pressed_pairs, pressed])
            yield (part, *heads, *frames([docs, times - 1], first[cuts], [pressed, pressed]))


def _runs(side_a: str, side_b: str, parts: int, links: int):
    def run(batches):
        both, here, number = sides(side_a, side_b), TaskContext.get().partitionId(), 0
        width = -(-len(both.bytes_a) // parts)
        held: list[Aligned] = []
        names: list[int | None] = []

        def flush():
            name = here << 24 | number
            done = 0
            for batch in held:
                columns = [batch.n_a, batch.n_b, batch.n_groups, batch.n_links]
                rows = len(batch.n_a)
                values = {"run": [name] * rows, "doc": range(done, done + rows), "doc_id": names[done : done + rows], "groups_sha256": batch.digests}
                values |= dict(zip(("n_a", "n_b", "n_groups", "n_links"), columns))
                yield filled(values, rows)
                batch.doc = batch.doc + done
                done += rows
            a, b, doc = (np.concatenate([getattr(x, n) for x in held]) for n in ("a", "b", "doc"))
            if len(a):
                for row in spilled(a, b, doc, parts, width):
                    yield filled({"run": [name], **dict(zip(("part", "pairs", "counts", "docs", "times"), ([v] for v in row)))}, 1)

        waiting: list[tuple[int | None, str | None]] = []
        size = found = 0

        def take():
            nonlocal found
            held.append(Aligned(both, [both.tokens(t) for _, t in waiting]))
            names.extend(i for i, _ in waiting)
            found += len(held[-1].a)
            waiting.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                waiting.append((doc_id, text.as_py()))
                size += len(waiting[-1][1] or "")
                if size >= AT_ONCE or len(waiting) >= DOCUMENTS // 8:
                    take()
                    size = 0
                    if found >= links or len(names) + DOCUMENTS // 8 > DOCUMENTS:
                        yield from flush()
                        number, found = number + 1, 0
                        held.clear()
                        names.clear()
        if waiting:
            take()
        if held:
            yield from flush()

    return run


def filled(values: dict, rows: int) -> pa.RecordBatch:
    """A batch of RUNS; columns that are not given are null."""
    return pa.RecordBatch.from_arrays([pa.array(values[f.name], f.type) if f.name in values else pa.nulls(rows, f.type) for f in RUNS], schema=RUNS)


def merged_runs(runs: list[Iterator[tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct pairs in order with their summed counts, block by block. Each run yields sorted blocks.

    The heap holds the last pair of each run's open block. Whatever is not behind the smallest of them is
    complete: no run can bring it again.
    """
    heads = {}
    heap: list[tuple[int, int]] = []

    def opened(i: int) -> None:
        block = next(runs[i], None)
        if block is not None:
            heads[i] = block
            heapq.heappush(heap, (int(block[0][-1]), i))

    for i in range(len(runs)):
        opened(i)
    while heap:
        until = heap[0][0]
        keys, counts = [], []
        for j, (k, c) in heads.items():
            n = int(np.searchsorted(k, np.uint64(until), "right"))
            keys.append(k[:n])
            counts.append(c[:n])
            heads[j] = (k[n:], c[n:])
        while heap and heap[0][0] == until:
            _, i = heapq.heappop(heap)
            del heads[i]
            opened(i)
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        yield keys[first], np.add.reduceat(counts, first)


def with_best(blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The blocks with a mark at the pairs that have their A id's highest count; an id's pairs stay together."""
    keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def marked(keys, counts):
        side = keys >> B_BITS
        first = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
        highest = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(keys))))
        return keys, counts, counts == highest

    for more, amounts in blocks:
        keys, counts = np.concatenate([keys, more]), np.concatenate([counts, amounts])
        whole = int(np.searchsorted(keys, keys[-1] >> B_BITS << B_BITS))  # the last id may go on
        if whole >= FRAME:
            yield marked(keys[:whole], counts[:whole])
            keys, counts = keys[whole:], counts[whole:]
    if len(keys):
        yield marked(keys, counts)


def opened_runs(table: pa.Table) -> list[Iterator[tuple[np.ndarray, np.ndarray]]]:
    def blocks(pairs, counts):
        for p, c in zip(pairs, counts):
            yield unpressed_pairs(p.as_py()), unpressed(c.as_py()).astype(np.int64)

    return [blocks(p, c) for p, c in zip(table.column("pairs"), table.column("counts"))]


def _merged(final: bool):
    def run(key, table):
        out: tuple[list, list, list] = ([], [], [])
        merged = merged_runs(opened_runs(table))
        for keys, counts, *best in with_best(merged) if final else merged:
            out[0].append(pressed_pairs(keys))
            out[1].append(pressed(counts))
            out[2].extend(pressed(b) for b in best)
        columns = [[key[1].as_py()], [key[0].as_py()], *([o] for o in out)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, MERGED)], schema=MERGED)

    return run


def _sums(key, records, known):
    """For each run: what this part's pairs add to the sums of its documents."""
    if not records.num_rows:
        return SUMS.empty_table()
    opened = {n: known.column(n)[0].as_py() for n in ("pairs", "counts", "best")}
    pairs = np.concatenate([unpressed_pairs(f) for f in opened["pairs"]])
    counts, best = (np.concatenate([unpressed(f) for f in opened[n]]).astype(np.int64) for n in ("counts", "best"))
    rows = []
    for row in range(records.num_rows):
        run, *columns = (records.column(n)[row].as_py() for n in ("run", "pairs", "counts", "docs", "times"))
        sums = np.zeros((2, DOCUMENTS), np.int64)
        for p, c, d, t in zip(*columns):
            at = np.repeat(np.searchsorted(pairs, unpressed_pairs(p)), unpressed(c).astype(np.int64))
            doc, times = unpressed(d).astype(np.int64), unpressed(t).astype(np.int64) + 1
            np.add.at(sums[0], doc, times * counts[at])
            np.add.at(sums[1], doc, times * best[at])
        length = int(np.flatnonzero(sums[0])[-1]) + 1
        rows.append((run, pressed(sums[0, :length]), pressed(sums[1, :length])))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SUMS)], schema=SUMS)


def _finished(key, docs, sums):
    docs = docs.combine_chunks()
    total = np.zeros((2, DOCUMENTS), np.int64)
    for i, name in enumerate(("count_sum", "n_best")):
        for blob in sums.column(name):
            values = unpressed(blob.as_py()).astype(np.int64)
            total[i, : len(values)] += values
    at = docs.column("doc").to_numpy()
    known = {"count_sum": total[0][at], "n_best": total[1][at]}
    return pa.Table.from_arrays([pa.array(known[f.name], f.type) if f.name in known else docs.column(f.name) for f in ALIGNED], schema=ALIGNED)


def aligned(
    docs: DataFrame,
    parts: int = 32,
    links: int = LINKS,
    id_column: str = "doc_id",
    text_column: str = "text",
    side_a: str = SIDE_A,
    side_b: str = SIDE_B,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row.

    ``parts``: pieces of a run, by the A id. ``links``: of a run, after which it is written.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    runs = written(source.mapInArrow(task(_runs(side_a, side_b, parts, links)), RUNS_DDL), "pair-runs")
    pieces = runs.where("part is not null").select("run", "part", "pairs", "counts", "docs", "times")
    most = pieces.select("run").distinct().count()

    def group(count: int, salt: int = 0):
        return F.pmod(F.xxhash64("run", F.lit(salt)), F.lit(1 + count // (FAN // 2)))

    pieces = pieces.withColumn("salt", group(most))
    level = pieces.select("part", F.col("salt").alias("run"), "pairs", "counts")
    while most > FAN:
        merged = level.groupBy("part", "run").applyInArrow(_merged(False), MERGED_DDL)
        level = written(merged.select("part", "run", "pairs", "counts"), "pair-counts")
        most = level.groupBy("part").count().agg(F.max("count")).first()[0]
        level = level.withColumn("run", group(most, most))
    last = level.withColumn("run", F.lit(0).cast("long"))
    counted = written(last.groupBy("part", "run").applyInArrow(_merged(True), MERGED_DDL).select("part", "pairs", "counts", "best"), "pair-best")
    asked = counted.join(pieces.select("part", F.col("salt").alias("group")).distinct(), "part")
    sums = pieces.groupBy("part", "salt").cogroup(asked.groupBy("part", "group")).applyInArrow(_sums, SUMS_DDL)
    sums = written(sums, "pair-sums")
    named = runs.where("part is null").select("run", "doc", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return named.groupBy("run").cogroup(sums.groupBy("run")).applyInArrow(_finished, ALIGNED_DDL)

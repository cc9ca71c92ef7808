"""Vector best-fit packing of tokenised documents into sequences.

Documents are tokenised and cut into pieces. Only the number of pieces of each
length matters for the packing, so the plan is made from that histogram (at most
``tokens`` rows, whatever the size of the corpus): a sequence is filled with the
length that scores best among those which fit its residual capacities for tokens,
documents and attention cost, and the pattern found is used for as many sequences
as the counts allow. Each pattern uses up one length at least, so there are at
most ``tokens`` patterns. A piece then takes the place that its rank among the
pieces of its length is due.

Defined results. A null text is empty; an empty document is the end token alone.
Null and repeated doc_ids and repeated rows are documents of their own. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import sys
import types
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adfeed.llm.common import task, written

TOKENIZER = "byte_bpe_50k"
END = 2  # fixed value: the id after each document
# Characters both tokenizer libraries class alike in any Unicode version.
OTHER = re.compile("[^\u0000-ɏ‐-‧₠-€]")
# Runs of white space that tiktoken's matcher cannot go through.
GAP = re.compile(r"\s{200}")


def worker_object(name: str, make: Callable[[], object]) -> object:
    """An object made once in each Python worker and kept over its tasks."""
    home = sys.modules.setdefault("_llm_worker_objects", types.ModuleType("_llm_worker_objects"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def token_ids(name: str = TOKENIZER) -> Callable[[str], np.ndarray]:
    """text -> ids as ``tokenizers`` gives them, without special tokens added.

    Texts of plain Latin characters go through tiktoken with the same vocabulary,
    which gives the same ids several times as fast; all others, texts that spell out
    the special token and those with wide gaps go through ``tokenizers`` itself.
    """

    def load():
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        def slow():
            return worker_object(f"slow_{name}", lambda: Tokenizer.from_file(public_tokenizers.path(f"{name}.json")))

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return slow, tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    slow, fast = worker_object(f"tokens_{name}", load)

    def ids(text: str) -> np.ndarray:
        if "<|" in text or not text.isascii() and OTHER.search(text) or GAP.search(text):
            return np.array(slow().encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return ids


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def pieces(docs: DataFrame, tokens: int, with_ids: bool = False, id_column: str = "doc_id", text_column: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): documents longer than ``tokens`` in pieces, the first one the shortest."""
    schema = PIECES.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else PIECES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_ids(tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END)).astype("<u4")
                first = len(ids) % tokens or tokens
                edges = [0, *range(first, len(ids) + 1, tokens)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                    part = ids[a:b]
                    rows.append((doc_id, piece, a, b - a, zlib.crc32(part.tobytes()), *([part.astype(np.int32)] if with_ids else [])))
                if len(rows) >= 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(task(cut), ddl)


def pattern_plan(histogram: dict[int, int], tokens: int, documents: int, cost: int, policy: str = "norm", weights: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset) for stretches of pieces.

    The pieces of a length with ranks from ``first`` to ``end`` go to consecutive
    sequences, at the same offset in each. ``norm`` takes the length that leaves the
    smallest weighted norm of the residuals, ``dot`` the one with the largest weighted
    dot product of demand and residuals; both count in shares of the capacities.
    """
    sizes = np.array(sorted(histogram, reverse=True), np.int64)
    left = np.array([histogram[s] for s in sizes], np.int64)
    capacity = np.array([tokens, documents, cost], np.float64)
    demand = np.stack([sizes, np.ones_like(sizes), sizes * sizes], 1)
    share, weight = demand / capacity, np.array(weights)
    if (demand > capacity).any():
        raise ValueError("a piece alone exceeds a capacity")
    taken, sequence, plan = np.zeros(len(sizes), np.int64), 0, []
    while left.any():
        room, used, pattern = capacity.copy(), np.zeros(len(sizes), np.int64), []
        choice = int(np.flatnonzero(left)[0])  # the longest piece opens a sequence
        while choice >= 0:
            pattern.append((choice, int(tokens - room[0])))
            used[choice] += 1
            room -= demand[choice]
            fits = np.flatnonzero((left > used) & (demand <= room).all(1))
            if not len(fits):
                break
            if policy == "norm":
                choice = int(fits[(((room / capacity - share[fits]) ** 2) * weight).sum(1).argmin()])
            else:
                choice = int(fits[((room / capacity * share[fits]) * weight).sum(1).argmax()])
        times = int((left[used > 0] // used[used > 0]).min())
        for index, offset in pattern:
            plan.append((int(sizes[index]), int(taken[index]), int(taken[index]) + times, sequence, offset))
            taken[index] += times
        left -= used * times
        sequence += times
    return plan


def packed(
    docs: DataFrame,
    tokens: int = 1024,
    documents: int | None = None,
    cost: int | None = None,
    policy: str = "norm",
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
    with_ids: bool = False,
    rows_per_stretch: int = 50_000,
    **columns: str,
) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset`` (place in the sequence).

    ``documents`` and ``cost`` (sum of squared lengths) default to what the token
    capacity implies, so that they bind only where they are given.
    """
    cut = pieces(docs, tokens, with_ids, **columns).withColumn("_row", F.monotonically_increasing_id())
    cut = written(cut, "pieces")  # from here on a row's number is a stored value
    stretches = max(1, -(-cut.count() // rows_per_stretch))
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(stretches)))
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("n"))
    sums = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = counts.select("length", "_salt", (F.sum("n").over(sums) - F.col("n")).alias("_before"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # one row per length
    plan = pattern_plan(histogram, tokens, documents or tokens, cost or tokens * tokens, policy, weights)
    ranges = docs.sparkSession.createDataFrame(plan, "length long, first long, end long, sequence long, offset long")
    ranges = ranges.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first", "sequence", "offset"))).alias("_ranges"))
    rank = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("_row")) - 1
    ranked = salted.withColumn("_rank", rank).join(before, ["length", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    at = F.element_at("_ranges", F.size(F.filter("_ranges", lambda r: r["first"] <= F.col("_rank"))))
    placed = ranked.join(ranges, "length").withColumn("_at", at)
    sequence = F.col("_at.sequence") + F.col("_rank") - F.col("_at.first")
    return placed.select(*[c for c in cut.columns if c != "_row"], sequence.alias("sequence_id"), F.col("_at.offset").alias("offset"))


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, ids: the token sequences, from pieces packed ``with_ids``."""
    parts = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))

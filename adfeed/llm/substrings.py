"""Removal of repeated passages by minimiser groups, in place of suffix trees.

Windows of ``width`` words are split into groups by a hash that equal windows share (a
minimiser, not a prefix), and each group is sorted. Windows that agree in all ``width``
words are neighbours then; all of them but the earliest are repeats. No tree is built,
and no longer common prefix is looked for.

1. Every window is assigned to the smallest hash among its runs of ``seed`` words, so
   equal windows agree wherever they stand. Consecutive windows of the same run are
   one record: about one record for eight windows.
2. Runs that occur in one record only cannot lie in a repeat. They are counted with
   sums made before the shuffle, and only the other records go on.
3. Texts whose words are all those of an earlier text are repeats as a whole and settled.
   The other records get their words (one join with the texts), which travel once to the
   group of their run. Runs of more than ``group`` records are grouped by a hash of
   the whole window instead, so that no group outgrows a task. Of records alike
   in one batch only the earliest travels, the others are settled on the spot: a
   passage in a third of all documents comes down to one record for each batch.
4. Each group is sorted and its repeats are marked; the marks meet their documents.

Defined results. A null text has no words. Texts of fewer than ``width`` words stay
whole. Documents without id come last; of documents with the same id and different
texts one is earlier (by the texts' hash); rows that repeat id and text are one
document and each get its result. An empty table gives no rows. Other columns are
ignored. The words of one document have to fit a task's memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeed.llm.common import run_hashes, task, WordHashes, written

MAX = (1 << 63) - 1
WORDS_AT_ONCE = 500_000

RECORDS = pa.schema([
    ("doc_id", pa.int64()), ("doc_key", pa.int64()), ("n_words", pa.int64()), ("sha256", pa.string()),
    ("runs", pa.list_(pa.int64())), ("times", pa.list_(pa.int8())),
])
SPANS = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("doc_key", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("words", pa.binary())])
MARKS = pa.schema([("doc_key", pa.int64()), ("start", pa.int32()), ("n", pa.int32())])
KEPT = pa.schema([("doc_id", pa.int64()), ("doc_key", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def window_records(hashes: np.ndarray, ends: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, run hash, and how often (1 or 2 for more) the run lies in the
    record, for the records in a row of texts that end at ``ends``."""
    runs = low = run_hashes(hashes, seed)
    reach, want = 1, width - seed + 1
    while reach < want:  # minimum over ever more runs
        step = min(reach, want - reach)
        low = np.minimum(low[:-step], low[step:])
        reach += step
    place = np.arange(len(low))
    end_of = np.repeat(ends, np.diff(ends, prepend=0))[: len(low)]
    whole = place + width <= end_of
    place, low, end_of = place[whole], low[whole], end_of[whole]
    if not len(place):
        return place, place, low, place
    first = np.concatenate([[0], np.flatnonzero((low[1:] != low[:-1]) | (end_of[1:] != end_of[:-1])) + 1])
    start, count, key = place[first], np.diff(np.append(first, len(place))), low[first]
    size = count + want - 1
    offset = np.cumsum(size) - size
    inside = np.arange(size.sum()) + np.repeat(start - offset, size)
    times = np.add.reduceat(runs[inside] == np.repeat(key, size), offset, dtype=np.int64)
    return start, count, key, np.minimum(times, 2)


def together(batch: pa.RecordBatch, *names: str) -> Iterator[tuple[list[list[bytes]], list[tuple]]]:
    """Rows of a batch, some words at a time: (words of each text, the named columns)."""
    texts, rows, size = [], [], 0
    columns = [batch.column(n).to_pylist() for n in names]
    for i, text in enumerate(batch.column("text")):
        words = words_of(text.as_py())
        texts.append(words)
        rows.append(tuple(c[i] for c in columns))
        size += len(words)
        if size >= WORDS_AT_ONCE:
            yield texts, rows
            texts, rows, size = [], [], 0
    if rows:
        yield texts, rows


def records_by_text(texts: list[list[bytes]], cache: WordHashes, width: int, seed: int) -> list[tuple[np.ndarray, ...]]:
    """window_records of each text, with places inside the text."""
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    hashes = np.concatenate([cache.of(t) for t in texts])
    if len(hashes) < width:
        none = np.empty(0, np.int64)
        return [(none, none, none.view(np.uint64), none)] * len(texts)
    start, count, run, times = window_records(hashes, ends, width, seed)
    out, a = [], 0
    for b, offset in zip(np.searchsorted(start, ends), ends - sizes):
        out.append((start[a:b] - offset, count[a:b], run[a:b], times[a:b]))
        a = b
    return out


def _records(width: int, seed: int):
    def run(batches):
        cache = WordHashes()
        for batch in batches:
            for texts, rows in together(batch, "doc_id", "doc_key"):
                found = records_by_text(texts, cache, width, seed)
                digests = [hashlib.sha256(b" ".join(t)).hexdigest() for t in texts]
                lists = [(r.view(np.int64), t) for _, _, r, t in found]
                yield batch_of([(*row, len(t), d, *x) for row, t, d, x in zip(rows, texts, digests, lists)], RECORDS)

    return run


def _spans(width: int, seed: int):
    """Records that may repeat, with their words; those which repeat an earlier one of the batch as marks (without words)."""

    def run(batches):
        cache = WordHashes()
        for batch in batches:
            for texts, rows in together(batch, "doc_id", "doc_key", "candidates"):
                found = records_by_text(texts, cache, width, seed)
                out: list[tuple] = []
                earliest: dict[tuple[int, bytes], tuple[int, int, int]] = {}
                order = sorted(range(len(rows)), key=lambda i: rows[i][:2])
                for i in order:
                    doc_id, doc_key, candidates = rows[i]
                    starts, counts, runs, _ = found[i]
                    words = texts[i]
                    for c in sorted(candidates, key=lambda c: c["i"]):
                        at, hot = c["i"], c["hot"]
                        start, n = int(starts[at]), int(counts[at])
                        stretches = ((start + j, 1) for j in range(n)) if hot else ((start, n),)
                        for a, m in stretches:
                            span = b" ".join(words[a : a + m + width - 1])
                            first = earliest.setdefault((m, span), (doc_id, doc_key, a))
                            if first != (doc_id, doc_key, a):
                                out.append((doc_key, doc_id, doc_key, a, m, None))
                            else:
                                key = int.from_bytes(hashlib.blake2b(span, digest_size=8).digest(), "big", signed=True) if hot else int(runs[at : at + 1].view(np.int64)[0])
                                out.append((key, doc_id, doc_key, a, m, span))
                if out:
                    yield batch_of(out, SPANS)

    return run


def subtree_repeats(records: list[tuple[int, int, int, int, bytes]], width: int) -> Iterator[tuple[int, int, int]]:
    """(doc_key, first window, number of windows) of the repeats in a group of records (doc_id, doc_key, start, n, words)."""
    if len(records) == 1 and records[0][3] == 1:
        return
    leaves = set()
    for doc_id, doc_key, start, n, span in records:
        words = span.split(b" ")
        for j in range(n):
            leaves.add((b" ".join(words[j : j + width]), doc_id, doc_key, start + j))
    leaves = sorted(leaves)
    repeats = sorted((doc_key, place) for (suffix, _, doc_key, place), (before, *_) in zip(leaves[1:], leaves) if suffix == before)
    i = 0
    while i < len(repeats):
        j = i + 1
        while j < len(repeats) and repeats[j] == (repeats[i][0], repeats[i][1] + j - i):
            j += 1
        yield *repeats[i], j - i
        i = j


def _marks(width: int):
    """Over rows sorted by key: settled marks pass, groups of records become marks."""

    def run(batches):
        group, group_key, out = [], None, []
        for batch in batches:
            for key, doc_id, doc_key, start, n, words in zip(*(c.to_pylist() for c in batch.columns)):
                if words is None:
                    out.append((doc_key, start, n))
                    continue
                if key != group_key:
                    out.extend(subtree_repeats(group, width) if group else ())
                    group, group_key = [], key
                group.append((doc_id, doc_key, start, n, words))
                if len(out) >= 50_000:
                    yield batch_of(out, MARKS)
                    out = []
        out.extend(subtree_repeats(group, width) if group else ())
        if out:
            yield batch_of(out, MARKS)

    return run


def _removed(width: int):
    def run(batches):
        for batch in batches:
            for texts, rows in together(batch, "doc_id", "doc_key", "marks"):
                out = []
                for words, (doc_id, doc_key, marks) in zip(texts, rows):
                    edge = np.zeros(len(words) + 1, np.int64)
                    for m in marks or ():
                        edge[m["start"]] += 1
                        edge[m["start"] + m["n"] + width - 1] -= 1
                    gone = np.cumsum(edge[:-1]) > 0
                    kept = b" ".join(w for w, g in zip(words, gone) if not g)
                    out.append((doc_id, doc_key, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass")))
                yield batch_of(out, KEPT)

    return run


KEPT_DDL = "doc_id long, doc_key long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def given_id() -> Column:
    return F.nullif("doc_id", F.lit(MAX)).alias("doc_id")


def keyed_texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    source = source.select(F.coalesce("id", F.lit(MAX)).alias("doc_id"), "text")
    return source.withColumn("doc_key", F.xxhash64("doc_id", "text"))


def whole_copies(records: DataFrame, width: int) -> DataFrame:
    """doc_key, start, n: all windows of the documents whose words are those of an earlier one."""
    long = records.where(F.col("n_words") >= width).select("sha256", "doc_id", "doc_key", "n_words")
    firsts = written(long.groupBy("sha256").agg(F.min(F.struct("doc_id", "doc_key")).alias("first")), "firsts")
    later = long.join(firsts, "sha256").where("doc_key <> first.doc_key").select("doc_key", "n_words").distinct()
    return written(later.select("doc_key", F.lit(0).alias("start"), (F.col("n_words") - width + 1).cast("int").alias("n")), "copies")


def repeat_marks(source: DataFrame, records: DataFrame, width: int, seed: int, group: int) -> DataFrame:
    """doc_key, marks: the repeated windows (start, n) of each document that has any."""
    runs = records.select("doc_key", F.posexplode(F.arrays_zip("runs", "times")).alias("i", "r")).select("doc_key", "i", "r.runs", "r.times")
    counts = runs.groupBy("runs").agg(F.sum("times").alias("total")).where("total > 1")
    repeated = counts.select("runs", (F.col("total") > group).alias("hot"))
    candidates = runs.join(repeated, "runs").groupBy("doc_key").agg(F.collect_set(F.struct("i", "hot")).alias("candidates"))
    copies = whole_copies(records, width)
    spans = source.join(candidates.join(copies, "doc_key", "left_anti"), "doc_key").select("doc_id", "doc_key", "text", "candidates")
    spans = spans.mapInArrow(task(_spans(width, seed)), "key long, doc_id long, doc_key long, start int, n int, words binary")
    marks = spans.repartition("key").sortWithinPartitions("key").mapInArrow(task(_marks(width)), "doc_key long, start int, n int")
    return marks.union(copies).groupBy("doc_key").agg(F.collect_list(F.struct("start", "n")).alias("marks"))


def all_records(source: DataFrame, width: int, seed: int) -> DataFrame:
    ddl = "doc_id long, doc_key long, n_words long, sha256 string, runs array<long>, times array<byte>"
    return written(source.mapInArrow(task(_records(width, seed)), ddl), "records")


def removed_counts(docs: DataFrame, width: int = 20, seed: int = 5, group: int = 1000, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row. Only texts that change meet their marks."""
    source = keyed_texts(docs, id_column, text_column)
    records = all_records(source, width, seed)
    marks = repeat_marks(source, records, width, seed, group)
    changed = source.join(marks, "doc_key").select("doc_id", "doc_key", "text", "marks").mapInArrow(task(_removed(width)), KEPT_DDL)
    changed = changed.select("doc_key", "n_removed", "kept_sha256").dropDuplicates(["doc_key"])
    answer = records.select("doc_id", "doc_key", "n_words", "sha256").join(changed, "doc_key", "left")
    return answer.select(given_id(), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))


def without_repeats(docs: DataFrame, width: int = 20, seed: int = 5, group: int = 1000, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_text for every row: the words that stay, joined by one space."""
    source = keyed_texts(docs, id_column, text_column)
    marks = repeat_marks(source, all_records(source, width, seed), width, seed, group)
    answer = source.join(marks, "doc_key", "left").select("doc_id", "doc_key", "text", "marks").mapInArrow(task(_removed(width)), KEPT_DDL)
    return answer.select(given_id(), "n_words", "n_removed", "kept_text")

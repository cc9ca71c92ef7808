"""Scores against exact counts kept in dictionaries."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adfeed.llm.common import ready
from adfeed.llm.lm import CountFilter, STEPS, bloom_piece, language_scores, merged, packed, packed_keys, unpacked, unpacked_keys


def tokens_of(text):
    return (text or "").encode().lower().split() + [None]


def brute(rows, prior=300.0):
    train = [tokens_of(t) for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    words = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip([None, *t], t))
    total, distinct = sum(words.values()), len(words)

    def level(c):
        i = int(np.searchsorted(STEPS, c, side="right"))
        return 0 if not i else (int(STEPS[i - 1]) + int(STEPS[i]) - 1) / 2

    out = []
    for doc_id, text in rows:
        t = tokens_of(text)
        base = sum(math.log10((words[w] + 1) / (total + distinct + 1)) for w in t)
        score = 0.0
        for v, w in zip([None, *t], t):
            score += math.log10((level(pairs[v, w]) + prior * (words[w] + 1) / (total + distinct + 1)) / (words[v] + prior))
        held = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2
        out.append((doc_id, held, len(t), sum(words[w] > 0 for w in t), total, base, score))
    return sorted(out, key=str)


def made(n=150):
    draw = random.Random(3)
    vocabulary = [f"w{int(draw.paretovariate(0.6))}" for _ in range(400)] + ["É"]
    rows = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(0, 60)))) for i in range(n)]
    return rows + [(n + i, rows[i][1].upper()) for i in range(20)] + [(5, rows[5][1])]


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 4000, "slice_bytes": 3000, "part_bytes": 1500}])
def test_against_exact_counts(spark, sizes):
    ready(spark)
    rows = made()
    got = sorted((tuple(r) for r in language_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), **sizes).collect()), key=str)
    want = brute(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want])
    # Probes for a missing pair succeed now and then (one in 45), which raises a score a little.
    more = np.array([(g[6] - w[6]) / g[2] for g, w in zip(got, want)])
    assert more.min() > -1e-9 and more.mean() < 0.015


def test_many_parts_read_the_texts_once(spark):
    ready(spark)
    rows = made()
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows if batch.num_columns == 2 else 0)
            yield batch

    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).mapInArrow(seen, "doc_id long, text string")
    got = sorted((tuple(r) for r in language_scores(docs, block_bytes=3000, slice_bytes=300, part_bytes=120).collect()), key=str)
    size = sum(len((t or "").encode()) for _, t in rows)
    assert (1 + size // 300) // 2 >= 8  # parts of two slices
    assert reads.value == 2 * len(rows)  # for their size, and for their words
    assert np.allclose([g[5] for g in got], [w[5] for w in brute(rows)])


def test_filter():
    draw = np.random.default_rng(4)
    keys = np.unique(draw.integers(0, 2**63, 20_000, dtype=np.uint64))
    counts = np.minimum(draw.zipf(1.5, len(keys)), 10**7)
    stored, others = keys[::2], keys[1::2]
    known = CountFilter(1, 0, 1, {0: bloom_piece(stored, counts[::2])})
    read = known.counts(stored)
    level = np.searchsorted(STEPS, counts[::2].astype(np.uint64), side="right")
    middle = (STEPS[level - 1] + STEPS[level] - 1) / 2
    assert (read >= middle).all() and (read == middle).mean() > 0.95  # never too low
    assert (known.counts(others) > 0).mean() < 0.05


def test_packing():
    keys = np.unique(np.random.default_rng(5).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (unpacked_keys(packed_keys(keys)) == keys).all() and (unpacked(packed(np.arange(9))) == np.arange(9)).all()
    joined = merged([(keys[::2], np.ones(500, np.int64)), (keys, np.ones(1000, np.int64))])
    assert (joined[0] == keys).all() and joined[1].sum() == 1500


def test_better_than_words_alone(spark):
    """On texts kept from training, word pairs say more than words."""
    ready(spark)
    draw = random.Random(8)
    follow = {f"w{i}": [f"w{draw.randrange(200)}" for _ in range(3)] for i in range(200)}
    rows = []
    for i in range(600):
        words = ["w0"]
        while len(words) < 40:
            words.append(draw.choice(follow[words[-1]]))
        rows.append((i, " ".join(words)))
    held = language_scores(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > 0.7 * held[1]


def test_odd_rows(spark):
    """Null and empty texts, null ids, repeated rows, a long text, clashing columns."""
    ready(spark)
    rows = [(1, None), (2, ""), (None, "a b"), (4, "a b"), (4, "a b"), (5, " \n"), (6, "x " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(7) for c in ("block", "row_key", "slice", "score", "held_out")})
    got = sorted((tuple(r) for r in language_scores(docs).collect()), key=str)
    want = brute(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want] and np.allclose([g[5] for g in got], [w[5] for w in want])


def test_empty_table(spark):
    ready(spark)
    assert language_scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []

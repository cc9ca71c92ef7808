"""Repeated passages against a brute-force search over all windows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from adfeed.llm.common import ready
from adfeed.llm.substrings import removed_counts, without_repeats


def brute(rows, width):
    """{(doc_id, text): (n_words, n_removed, kept)}; null ids last, then by the texts' order of appearance."""
    texts = {}
    for doc_id, text in rows:
        texts.setdefault((doc_id is None, doc_id or 0, text or ""), (text or "").encode().split())
    seen, out = set(), {}
    for key in sorted(texts, key=lambda k: k[:2]):
        words = texts[key]
        gone = set()
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if window in seen:
                gone.update(range(i, i + width))
            seen.add(window)
        out[key] = (len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode())
    return out


def made(seed, size=120):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "ß|", "***"]
    passages = [" ".join(draw.choices(vocabulary, k=draw.randint(5, 40))) for _ in range(6)]
    rows = []
    for i in range(size):
        parts = [" ".join(draw.choices(vocabulary, k=draw.randint(0, 30)))]
        parts += draw.choices(passages, k=draw.randint(0, 3))
        if i % 9 == 0:
            parts.append("again " * draw.randint(0, 50))
        if i % 11 == 0:
            parts.append("one two three " * 9)
        rows.append((i, draw.choice([" ", "\n", "\t  "]).join(parts)))
    rows += [(1000 + i, rows[i][1]) for i in range(0, 30, 3)]  # copies
    return rows


@pytest.mark.parametrize("group", [1000, 3])
@pytest.mark.parametrize("width,seed", [(20, 5), (6, 2), (5, 5)])
def test_against_brute_force(spark, width, seed, group):
    ready(spark)
    rows = made(width)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows, width)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in removed_counts(docs, width, seed, group).collect()}
    assert got == {k[1]: (n, m, hashlib.sha256(t.encode()).hexdigest()) for k, (n, m, t) in want.items()}
    texts = {r["doc_id"]: r["kept_text"] for r in without_repeats(docs, width, seed, group).collect()}
    assert texts == {k[1]: t for k, (_, _, t) in want.items()}


def test_odd_rows(spark):
    """Null and empty texts, null ids, repeated rows, clashing columns, a long text."""
    ready(spark)
    long = " ".join(f"x{i}" for i in range(60_000))
    line = " ".join(f"y{i}" for i in range(8))
    rows = [(1, None), (2, ""), (3, " \n "), (4, long), (5, long + " end"), (None, line), (7, line), (7, line), (8, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("other") for c in ("doc_key", "runs", "marks", "key", "words")})
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"]) for r in removed_counts(docs, 8, 3).collect()), key=str)
    want = [(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 60_000, 0), (5, 60_001, 60_000), (None, 8, 8), (7, 8, 0), (7, 8, 0), (8, 1, 0)]
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    ready(spark)
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert removed_counts(docs).collect() == [] and without_repeats(docs).collect() == []

"""Groups of near copies against the similarity of every pair."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adfeed.llm import jaccard
from adfeed.llm.common import components, ready
from adfeed.llm.jaccard import grouped, kept_rows, overlaps


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


def brute(rows, size, percent):
    sets = [(doc_id, shingles(text, size)) for doc_id, text in rows]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        ids = [x for x in (doc_id, least.get(find(i))) if x is not None]
        least[find(i)] = min(ids) if ids else None
    return sorted(((d, len(s), least[find(i)]) for i, (d, s) in enumerate(sets)), key=str)


def made(seed):
    draw = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(300)] + ["É", "z|"]
    line = " ".join(draw.choices(vocabulary, k=30))
    rows, n = [], 0
    for _ in range(25):
        words = draw.choices(vocabulary, k=draw.choice([1, 2, 3, 5, 12, 40, 120]))
        for _ in range(draw.choice([1, 1, 2, 6])):
            copy = list(words)
            for _ in range(draw.choice([0, 1, 1, 2, 4])):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            text = " ".join(copy)
            rows.append((n, draw.choice([text, text.upper(), text.replace(" ", "\n "), line + " " + text])))
            n += 1
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80), (2, 50)])
def test_against_all_pairs(spark, size, percent):
    ready(spark)
    rows = made(size)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in grouped(docs, size, percent).collect()), key=str)
    want = brute(rows, size, percent)
    assert got == want and len({c for _, _, c in want}) < len(want)
    kept = {r["doc_id"] for r in kept_rows(docs, size, percent).collect()}
    assert kept == {c for _, _, c in want}


def test_large_families(spark, monkeypatch):
    """Blocks in place of pairs give the same groups."""
    ready(spark)
    monkeypatch.setattr(jaccard, "LARGE", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    draw = random.Random(1)
    words = [f"a{i}" for i in range(80)]
    rows = []
    for i in range(60):
        copy = list(words)
        for _ in range(draw.choice([0, 1, 2, 3])):
            copy[draw.randrange(80)] = f"b{draw.randrange(9)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in grouped(docs, 4, 85).collect()), key=str)
    assert got == brute(rows, 4, 85) and len({c for _, _, c in got}) > 3


def test_overlaps():
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 9000, size).astype(np.uint64)) for size in (0, 1, 40, 6000, 5000, 300)]
    assert overlaps(sets[:3], sets[2:]).tolist() == [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets[:3]]
    assert overlaps(sets[3:5], sets).tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets[3:5]]


def test_chains_of_links(spark):
    """A document moves by one word at a time; only neighbours link, all are one component."""
    ready(spark)
    words = [f"a{i}" for i in range(200)]
    rows = [(50 - i, " ".join(words[i : i + 60])) for i in range(40)]
    got = {r["doc_id"]: r["component_id"] for r in grouped(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()}
    assert {(d, 57, c) for d, c in got.items()} == set(brute(rows, 4, 85)) and set(got.values()) == {11}


def test_odd_rows(spark):
    """Null, empty and long texts, null ids, repeated rows, clashing columns."""
    ready(spark)
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " "), (4, long), (5, long + " end"), (None, "a b c"), (7, "A  b C"), (7, "A  b C"), (None, "q r"), (9, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(0) for c in ("n", "row_key", "digest", "set", "component")})
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in grouped(docs, 4, 85).collect()), key=str)
    assert got == brute(rows, 4, 85)
    kept = kept_rows(docs, 4, 85)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 7, 7, None, 9], key=str)


def test_empty_table(spark):
    ready(spark)
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert grouped(docs).collect() == [] and kept_rows(docs).collect() == []


def test_components(spark):
    ready(spark)
    draw = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, draw.randrange(1000, 1100)) for _ in range(60)] + [(3, 3), (None, 4)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 7, **{b: 7 for a, b in pairs if a == 7}}

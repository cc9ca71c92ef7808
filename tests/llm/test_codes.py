"""Codes by memoised cells, against brute force over all entries in plain integers."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adfeed.llm import queries
from adfeed.llm.codes import Cells, coded
from adfeed.llm.common import ready


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.integers(-300, 300), min_size=3, max_size=3), min_size=1, max_size=40),
    st.lists(st.lists(st.integers(-300, 300), min_size=3, max_size=3), min_size=1, max_size=12),
    st.sampled_from([1, 7, 64]), st.sampled_from([0, 3, 1000]),
)
def test_survivors_hold_the_nearest_entry(parts, book, width, remembered):
    cells = Cells(np.array(book), width, remembered)
    for _ in range(2):  # the second time out of the memory
        entry, distance = cells.nearest(np.array(parts))
        for p, e, d in zip(parts, entry, distance):
            all_of = [sum((a - b) ** 2 for a, b in zip(p, c)) for c in book]
            assert d == min(all_of) and e == all_of.index(d)
    assert len(cells.cells) <= remembered


def test_cells_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr("adfeed.llm.codes.mixed", lambda values: values * np.uint64(0))
    cells = Cells(np.array([[0, 0], [100, 100], [-100, 5]]), 16, 1000)
    parts = np.array([[-90, 0], [99, 90], [1, 2], [-90, 1]])
    for rows in (parts, parts[1:], parts[:1]):
        entry, _ = cells.nearest(rows)
        assert entry.tolist() == [int(((r - cells.book) ** 2).sum(1).argmin()) for r in rows]


def test_few_entries_are_evaluated_and_cells_are_remembered():
    draw = np.random.default_rng(2)
    parts = draw.integers(-20, 20, (4000, 4))
    cells = Cells(draw.integers(-200, 200, (64, 4)), 24, 1000)
    cells.nearest(parts)
    made = cells.made
    cells.nearest(parts)
    assert cells.made == made < 40 and cells.evaluated < 8000 * 40


def brute(rows, positions=16, entries=64, rounds=2):
    """vec_id, code, error, label_error, digest in plain Python integers; rows: (vec_id, vector, label)."""
    kept = [(i, [math.floor(256 * v) for v in x], label) for i, x, label in rows if x and all(v is not None and math.isfinite(v) for v in x)]
    size = len(kept[0][1]) // positions
    cut = [[x[p * size : (p + 1) * size] for p in range(positions)] for _, x, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[cut[k][p] for k in order] for p in range(positions)]

    def nearest(p, part):
        found = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in books[p]]
        return found.index(min(found)), min(found)

    for _ in range(rounds):
        new = []
        for p in range(positions):
            groups = {}
            for parts in cut:
                groups.setdefault(nearest(p, parts[p])[0], []).append(parts[p])
            new.append([[sum(c) // len(c) for c in zip(*groups[e])] if e in groups else old for e, old in enumerate(books[p])])
        books = new
    found = [[nearest(p, parts[p]) for p in range(positions)] for parts in cut]
    errors = [sum(d for _, d in f) for f in found]
    labels = {}
    for (_, _, label), error in zip(kept, errors):
        labels[label] = labels.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(v) for book in books for e in book for v in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for e, _ in f), error, labels[label], digest) for (i, _, label), f, error in zip(kept, found, errors)), key=str)


def made(n, dimension=32, seed=3):
    draw = random.Random(seed)
    return [(i, [draw.gauss(0, 0.1) for _ in range(dimension)], draw.choice([None, 1, 2])) for i in draw.sample(range(-20, 4 * n), n)]


@pytest.mark.parametrize("n", [5, 64, 300])
def test_equal_to_brute_force(spark, n):
    ready(spark)
    rows = made(n)
    rows += rows[:3] + [(None, rows[0][1], 1), (None, rows[1][1], None)]  # repeated rows, null ids
    bad = [(7000, None, 1), (7001, [], 1), (7002, [None] * 32, 2), (7003, [float("nan")] * 32, None), (7004, [0.1] * 31 + [float("inf")], 1)]
    df = spark.createDataFrame([(x, i, label, "c", 0) for i, x, label in rows + bad], "embedding array<double>, vec_id long, label int, code string, error int")
    out = coded(df.repartition(4))
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows)


def test_ties_large_values_and_wide_vectors(spark):
    ready(spark)
    rows = [(i, [float(i % 3)] * 15 + [200_000.0 * (-1) ** i], "x") for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    assert sorted((tuple(r) for r in coded(df).collect()), key=str) == brute(rows)
    for wrong in ([(1, [1.0] * 15, "x")], [(1, [1.0] * 16, "x"), (2, [1.0] * 32, "x")]):
        with pytest.raises(ValueError):
            coded(spark.createDataFrame(wrong, "vec_id long, embedding array<double>, label string"))
    with pytest.raises(Exception, match="beyond"):
        coded(spark.createDataFrame([(1, [1e9] * 16, "x")], "vec_id long, embedding array<double>, label string"))


def test_empty_table(spark):
    ready(spark)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    out = coded(empty)
    assert out.count() == 0 and out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_query_meets_its_contract_and_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    out = queries.QUERIES["op12_grid_cells"](spark, folder)
    assert dict(out.dtypes) == {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}
    found = sorted(tuple(r) for r in out.collect())
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    assert found == sorted(brute([tuple(r) for r in vectors]))
    base = duckdb.connect()
    base.sql(f"CREATE VIEW embeddings AS FROM '{folder}/embeddings.parquet'")
    wanted = base.sql(queries.ORACLE["op12_grid_cells"]).project("vec_id, code, error, label_error, codebooks_sha256").fetchall()
    assert found == sorted(wanted)

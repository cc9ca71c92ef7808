"""Near vectors against the cosine of every pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from adfeed.llm.common import ready
from adfeed.llm.embeddings import code_pairs, codes_of, learned_rotation, near_vectors


def brute(rows, least=0.95):
    good = [(i, v) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    out, label = {}, {i: i for i, _ in rows}
    links = {i: [] for i, _ in rows}
    for i, v in good:
        for j, w in good:
            if i != j and len(v) == len(w) and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= least:
                links[i].append(j)
    changed = True
    while changed:
        changed = False
        for i in links:
            low = min([label[i], *(label[j] for j in links[i])])
            changed |= low < label[i]
            label[i] = low
    for i in links:
        out[i] = (len(links[i]), label[i], label[i] == i)
    return out


def made(seed, dim=32):
    draw = np.random.default_rng(seed)
    vectors = []
    for size in (1,) * 60 + (2, 3, 5, 9, 40):
        centre = draw.normal(size=dim)
        for _ in range(size):
            vectors.append(centre + draw.normal(size=dim) * draw.choice([0.02, 0.1, 0.15]))
    vectors += [2 * vectors[-1], vectors[-1], -vectors[-2]]
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("dim", [16, 32, 96])
def test_recall(spark, dim):
    """No false link; at least 0.9 of the links of a brute-force search."""
    ready(spark)
    rows = made(dim, dim)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    want = brute(rows)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _, _ in got.values()) >= 0.9 * sum(n for n, _, _ in want.values()) > 0


def test_tables(spark):
    """All codes up to eight bits apart meet, and each pair once."""
    ready(spark)
    draw = np.random.default_rng(1)
    codes = [int(c) for c in draw.integers(-(2**63), 2**63, 30)]
    for base in codes[:20]:
        for flips in (1, 2, 5, 8, 8):
            other = base & (2**64 - 1)
            for bit in draw.choice(64, flips, replace=False).tolist():
                other ^= 1 << bit
            codes.append(other - 2**64 if other >> 63 else other)
    codes = sorted(set(codes))
    found = [(r["code_a"][0], r["code_b"][0]) for r in code_pairs(spark.createDataFrame([(1, [c]) for c in codes], "dim int, code array<long>")).collect()]
    apart = {(a, b): bin((a ^ b) & (2**64 - 1)).count("1") for a in codes for b in codes if a < b}
    assert len(found) == len(set(found)) and set(found) <= set(apart)
    assert {p for p, d in apart.items() if d <= 8} <= set(found)


def test_two_flips_and_the_farthest(spark):
    """With two flips all codes up to 14 bits apart meet, each pair once, except those beyond the farthest."""
    ready(spark)
    draw = np.random.default_rng(4)
    codes = draw.integers(-(2**63), 2**63, (12, 2))
    near = codes.copy()
    for row, flips in zip(near, (1, 2, 4, 6, 8, 10, 12, 14, 14, 13, 9, 3)):
        for bit in draw.choice(64, flips, replace=False).tolist():
            row[0] ^= np.uint64(1 << bit).astype(np.int64)
    rows = [[int(x) for x in c] for c in np.concatenate([codes, near])]
    table = spark.createDataFrame([(1, c) for c in rows], "dim int, code array<long>")
    for farthest in (None, 8):
        found = [(tuple(r["code_a"]), tuple(r["code_b"])) for r in code_pairs(table, 2, farthest).collect()]
        apart = {tuple(sorted((tuple(a), tuple(b)))): sum(bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(a, b)) for a, b in zip(rows[:12], rows[12:])}
        want = {p for p, d in apart.items() if farthest is None or d <= farthest}
        assert len(found) == len(set(found)) and want <= set(found)
        assert farthest is None or not (set(apart) - want) & set(found)


@pytest.mark.parametrize("mean", [0.0, 0.5, 0.7, 0.8])
def test_recall_where_vectors_share_a_direction(spark, mean):
    ready(spark)
    draw = np.random.default_rng(int(mean * 10))
    common = draw.normal(size=64)
    aside = draw.normal(size=(900, 64))
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    own = np.sqrt(mean) * common / np.linalg.norm(common) + np.sqrt(1 - mean) * aside
    own /= np.linalg.norm(own, axis=1, keepdims=True)
    off = draw.normal(size=own.shape)
    off -= (off * own).sum(1, keepdims=True) * own
    cosine = draw.uniform(0.9501, 0.96, (900, 1))
    vectors = np.concatenate([own, cosine * own + np.sqrt(1 - cosine**2) * off / np.linalg.norm(off, axis=1, keepdims=True)])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    want = int((np.triu(unit @ unit.T, 1) >= 0.95).sum())
    out = near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>"))
    found = out.agg(F.sum("n_links")).first()[0] / 2
    assert want >= 900 and 0.95 * want <= found <= want


def test_balanced_codes():
    sample = np.random.default_rng(2).normal(size=(3000, 24))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    bits = np.unpackbits(codes_of(sample, learned_rotation(sample)).view(np.uint8).reshape(len(sample), 8), axis=1)
    assert bits.shape == (3000, 64) and abs(bits.mean(0) - 0.5).max() < 0.1


def test_odd_rows(spark):
    """Null, empty, zero and non-finite vectors, other lengths, null ids, repeated rows, clashing columns, huge values."""
    ready(spark)
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0, 3.0]), (2, [2.0, 4.0, 6.0]), (2, [2.0, 4.0, 6.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, nan, 2.0]), (7, [1.0, inf, 2.0]),
        (8, [1.0, None, 3.0]), (9, [1.0, 2.0]), (None, [1.0, 2.0, 3.01]), (10, [1e300, 2e300, 3e300]), (11, [-1.0, -2.0, -3.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("code", "item", "block", "vector", "label")})
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(table).collect()), key=str)
    group = [(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (None, 4, 1, False), (10, 4, 1, False)]
    assert got == sorted(group + [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 11)], key=str)


def test_empty_table(spark):
    ready(spark)
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []

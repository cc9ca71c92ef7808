"""Poisson replication: counts, means, order and whole results."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adfeed.llm.common import ready
from adfeed.llm.mixing import mixed_sources, poisson_steps


def docs_of(spark, n=6000):
    source = F.when(F.col("id") % 3 > 0, "big").when(F.col("id") % 9 == 0, "small").otherwise("mid")
    return spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w"), (F.col("id") % 50).cast("int")).alias("text"), source.alias("source"))


def uniform(seed, name):
    return (int(hashlib.md5(f"{seed}|{name}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def poisson(rate, u):
    k, term = 0, math.exp(-rate)
    total = term
    while total <= u:
        k += 1
        term *= rate / k
        total += term
    return k


def test_counts_are_the_inverted_distribution(spark):
    ready(spark)
    docs = docs_of(spark)
    rows = docs.collect()
    got = mixed_sources(docs, {"big": 1, "mid": 2, "small": 1}, seed=7).collect()
    size = Counter()
    for r in rows:
        size[r["source"]] += len(r["text"]) + 1
    rate = {s: w / 4 * sum(size.values()) / size[s] for s, w in (("big", 1), ("mid", 2), ("small", 1))}
    want = {r["doc_id"]: poisson(rate[r["source"]], uniform(7, r["doc_id"])) for r in rows}
    copies = Counter(r["doc_id"] for r in got)
    assert copies == Counter({i: n for i, n in want.items() if n})
    assert {(r["doc_id"], r["copy"]) for r in got} == {(i, c) for i, n in want.items() for c in range(n)}
    assert all(abs(r["rate"] - rate[r["source"]]) < 1e-12 and r["n_copies"] == want[r["doc_id"]] for r in got)
    share = Counter()
    for r in got:
        share[r["source"]] += len(r["text"]) + 1
    assert all(abs(share[s] / sum(share.values()) - w / 4) < 0.05 for s, w in (("big", 1), ("mid", 2), ("small", 1)))


def test_order_is_that_of_a_random_key(spark):
    ready(spark)
    rows = mixed_sources(docs_of(spark), partitions=3).withColumn("p", F.spark_partition_id()).collect()
    for p in range(3):
        keys = [r["order_key"] for r in rows if r["p"] == p]
        assert keys == sorted(keys) and len(keys) > 1000
        ids = [r["doc_id"] for r in rows if r["p"] == p]
        assert 0.4 < sum(a < b for a, b in zip(ids, ids[1:])) / len(ids) < 0.6


@pytest.mark.parametrize("rate", [0.01, 1.0, 3.7, 80.0, 512.0])
def test_steps_are_those_of_the_distribution(spark, rate):
    steps = spark.range(1).select(poisson_steps(F.lit(rate)).alias("s")).first()["s"]
    logs = [k * math.log(rate) - rate - math.lgamma(k + 1) for k in range(len(steps))]
    assert all(abs(a - b) < 1e-9 for a, b in zip(steps, [math.fsum(map(math.exp, logs[: k + 1])) for k in range(len(steps))]))
    assert steps[-1] > 1 - 1e-9


def test_very_large_rates_and_zero_weights(spark):
    ready(spark)
    rows = [(i, "x" * 9999, "huge") for i in range(200)] + [(1000, "", "tiny"), (1001, "y", "none")]
    got = mixed_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), {"huge": 1, "tiny": 0.001, "none": 0}).collect()
    n = Counter(r["source"] for r in got)
    assert "none" not in n and abs(n["tiny"] - 0.001 / 1.001 * 2_000_003) < 150


def test_odd_rows(spark):
    """Null sources, ids and texts, repeated rows, clashing columns."""
    ready(spark)
    rows = [(None, None, None), (1, None, None), (2, "", "a"), (3, "t", "a"), (3, "t", "a"), (None, "t" * 50_000, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("x") for c in ("copy", "Rate", "n_copies", "order_key", "_source2", "bytes")})
    out = mixed_sources(docs, {"a": 3.0}, default_weight=1.0, seed=3)
    got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert out.columns == ["doc_id", "text", "source", "_source2", "bytes", "copy", "n_copies", "rate", "order_key"]
    sizes, weights = {None: 2, "a": 5, "b": 50_001}, {None: 1, "a": 3, "b": 1}
    for doc_id, text, source in set(rows):
        rate = weights[source] / 5 * 50_008 / sizes[source]
        draws = max(1, math.ceil(rate / 512))
        name = doc_id if doc_id is not None else text or ""
        uniforms = [uniform(3, name)] + [uniform(3, f"#{j}|{name}") for j in range(1, draws)]
        assert got[doc_id, text] == sum(poisson(rate / draws, u) for u in uniforms) * rows.count((doc_id, text, source))


def test_empty_table(spark):
    ready(spark)
    assert mixed_sources(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []


def test_a_high_rate_is_a_sum_of_poisson_numbers(spark):
    ready(spark)
    rows = [(i, "tiny", "x") for i in range(60)] + [(1000, "big", "y" * 240_000)]
    got = mixed_sources(spark.createDataFrame(rows, "doc_id long, source string, text string")).where("source = 'tiny'").groupBy("doc_id").agg(
        F.first("rate").alias("rate"), F.max("n_copies").alias("n"), F.count("*").alias("copies")
    ).collect()
    rate = got[0]["rate"]
    draws = math.ceil(rate / 512)
    assert 900 < rate < 1100 and draws == 2 and len(got) == 60

    def drawn(doc_id):
        texts = [f"29|{doc_id}"] + [f"29|#{j}|{doc_id}" for j in range(1, draws)]
        return sum(poisson(rate / draws, (int(hashlib.md5(t.encode()).hexdigest()[:13], 16) + 0.5) / 2**52) for t in texts)

    assert all(r["n"] == r["copies"] and abs(r["n"] - drawn(r["doc_id"])) <= 1 for r in got)
    counts = [r["n"] for r in got]
    mean = sum(counts) / 60
    assert abs(mean / rate - 1) < 0.02 and 0.5 < sum((n - mean) ** 2 for n in counts) / 59 / rate < 1.7

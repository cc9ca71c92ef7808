"""The two-pass shuffle: laws, reproducibility and an even spread."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adfeed.llm.common import ready, shared_path
from adfeed.llm.sharding import shuffled_shards, write_shards


def docs_of(spark, n, parts=3):
    return spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text")).repartition(parts)


def order(df):
    return [r["doc_id"] for r in sorted(df.collect(), key=lambda r: (r["shard"], r["slot"]))]


@pytest.mark.parametrize("n,bucket_bytes", [(1000, 1 << 20), (1003, 500), (5, 10), (16, 40), (17, 40)])
def test_rows_law(spark, n, bucket_bytes):
    ready(spark)
    rows = shuffled_shards(docs_of(spark, n), 16, bucket_bytes).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(n)) and {r["law"] for r in rows} == {"rows"}
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - (min(sizes.values()) if len(sizes) == 16 else 0) <= 1
    for shard, size in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(size))


def test_order_depends_on_rows_and_seed_alone(spark):
    ready(spark)
    one = order(shuffled_shards(docs_of(spark, 500, 2), 4, 700))
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert order(shuffled_shards(docs_of(spark, 500, 7), 4, 700)) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert order(shuffled_shards(docs_of(spark, 500), 4, 700, seed=18)) != one


def test_places_are_evenly_spread(spark):
    """Neighbours end up far apart, and first rows come from everywhere."""
    ready(spark)
    found = order(shuffled_shards(docs_of(spark, 4000), 16, 4000))
    gaps = [abs(a - b) for a, b in zip(found, found[1:])]
    assert 1200 < sum(gaps) / len(gaps) < 1470  # 4000 / 3 for a random order
    assert 1800 < sum(found[:400]) / 400 < 2200
    assert sum(a < b for a, b in zip(found, found[1:])) in range(1800, 2200)


def test_written_shards(spark):
    ready(spark)
    path = shared_path(spark, "shards")
    write_shards(shuffled_shards(docs_of(spark, 100), 4, 500), path)
    assert sorted(f for f in os.listdir(path) if f.startswith("shard=")) == [f"shard={i}" for i in range(4)]
    assert spark.read.parquet(path).count() == 100


def test_odd_rows(spark):
    """Null ids and texts, repeated rows, a long text, clashing columns."""
    ready(spark)
    rows = [(None, None)] * 5 + [(None, "a"), (1, ""), (2, "x" * 500_000)] + [(3, "same")] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("SHARD", "slot", "law", "bucket", "pos", "start", "r", "place")})
    out = shuffled_shards(docs, 4, 30)
    got = out.collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(rows, key=str) and set(Counter(r["shard"] for r in got).values()) == {7}
    assert out.columns == ["doc_id", "text", "bucket", "pos", "start", "r", "place", "shard", "slot", "law"] and {r["place"] for r in got} == {"x"}


def test_empty_table(spark):
    ready(spark)
    assert shuffled_shards(spark.createDataFrame([], "doc_id long, text string")).collect() == []

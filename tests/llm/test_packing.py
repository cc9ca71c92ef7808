"""Packing: pieces against the tokenizer, plans against their capacities, an exact round trip."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adfeed.llm.common import ready
from adfeed.llm.packing import packed, pattern_plan, sequences, token_ids

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def made(n=120):
    draw = random.Random(4)
    words = ["the", "éthique", "12", "日本", "<|endoftext|>", "x" * 30, "it's", "\n\n", "  ", "###", "ß"]
    return [(i, " ".join(draw.choices(words, k=draw.choice([0, 1, 3, 20, 60, 200])))) for i in range(n)]


def test_fast_and_slow_tokens_agree():
    encode, draw = token_ids(), random.Random(3)
    letters = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2028), *range(0x20A0, 0x20AD)]]
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 30))) for _ in range(4000)]
    texts += [t for _, t in made()] + ["a" * 5000, " " * 5000, "<|endoftext|>", "<|x", "a\x1cb\x85c", "日本語テキスト", "I'LL we've"]
    for text in texts:
        assert encode(text).tolist() == ids_of(text)[:-1], text[:80]


@pytest.mark.parametrize("tokens,stretch", [(64, 7), (1024, 250_000)])
def test_pieces_and_places(spark, tokens, stretch):
    ready(spark)
    rows = made()
    out = packed(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), tokens, rows_per_stretch=stretch).collect()
    ids = {i: ids_of(t) for i, t in rows}
    for doc_id, whole in ids.items():
        mine = sorted((r for r in out if r["doc_id"] == doc_id), key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine))) and sum(r["length"] for r in mine) == len(whole)
        assert [r["start"] for r in mine] == list(np.cumsum([0] + [r["length"] for r in mine])[:-1])
        assert all(r["length"] == tokens for r in mine[1:]) and 0 < mine[0]["length"] <= tokens
        for r in mine:
            part = np.array(whole[r["start"] : r["start"] + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
    places = {}
    for r in out:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= tokens
    assert sorted(places) == list(range(len(places)))
    assert len(places) <= 1.03 * sum(map(len, ids.values())) / tokens + 2


def test_sequences_hold_every_token_once(spark):
    ready(spark)
    rows = made(60)
    placed = packed(spark.createDataFrame(rows, "doc_id long, text string"), 100, with_ids=True)
    found = {r["sequence_id"]: r["ids"] for r in sequences(placed).collect()}
    back = {}
    for r in placed.collect():
        assert found[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
        back.setdefault(r["doc_id"], {})[r["start"]] = r["ids"]
    assert {i: [x for _, part in sorted(parts.items()) for x in part] for i, parts in back.items()} == {i: ids_of(t) for i, t in rows}


@pytest.mark.parametrize("policy", ["norm", "dot"])
@pytest.mark.parametrize("documents,cost", [(100, 100 * 100), (3, 100 * 100), (100, 4000), (2, 6000)])
def test_plans_keep_all_capacities(policy, documents, cost):
    draw = random.Random(documents + cost)
    histogram = {length: draw.randint(1, 40) for length in draw.sample(range(1, 61), 40)}
    plan = pattern_plan(histogram, 100, documents, cost, policy, (1.0, 0.5, 0.5))
    sequences, ranks = {}, {}
    for length, first, end, sequence, offset in plan:
        ranks.setdefault(length, []).append((first, end))
        for i in range(end - first):
            sequences.setdefault(sequence + i, []).append((offset, length))
    for length, stretches in ranks.items():
        edges = sorted(stretches)
        assert edges[0][0] == 0 and edges[-1][1] == histogram[length] and all(a[1] == b[0] for a, b in zip(edges, edges[1:]))
    for parts in sequences.values():
        assert [o for o, _ in sorted(parts)] == list(np.cumsum([0] + [n for _, n in sorted(parts)])[:-1])
        assert sum(n for _, n in parts) <= 100 and len(parts) <= documents and sum(n * n for _, n in parts) <= cost
    least = max(sum(k * v for k, v in histogram.items()) / 100, sum(histogram.values()) / documents, sum(k * k * v for k, v in histogram.items()) / cost)
    assert len(sequences) <= 1.35 * least + 1


def test_hot_length_and_repeated_rows(spark):
    ready(spark)
    rows = [(7, "the same text")] * 300 + [(i, "other " * (i % 40)) for i in range(200)]
    out = packed(spark.createDataFrame(rows, "doc_id long, text string"), 50, rows_per_stretch=20).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in out}) == len(out) and sum(r["doc_id"] == 7 and r["length"] == 4 for r in out) >= 300


def test_odd_rows(spark):
    """Null and empty texts, null ids, a long text, clashing columns."""
    ready(spark)
    rows = [(1, None), (2, ""), (None, "a"), (4, "word " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("piece", "length", "_row", "_salt", "sequence_id", "offset", "ids")})
    out = packed(docs, 1024).collect()
    total = {}
    for r in out:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == {i: len(ids_of(t)) for i, t in rows}


def test_empty_table(spark):
    ready(spark)
    assert packed(spark.createDataFrame([], "doc_id long, text string")).collect() == []

"""The pipeline's stages, each against what its operator has to do with its own input."""

import random
from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from adfeed.llm.common import ready, shared_path
from test_exact import normal
from test_jaccard import brute as near_groups
from test_packing import ids_of
from test_quality import bad, good


@pytest.fixture(scope="module")
def folder(spark):
    ready(spark)
    draw = random.Random(12)
    rows, labels, kinds = [], [], {}
    for i in range(700):
        kind = draw.choice(["good"] * 6 + ["symbols", "capitals", "table", "repeats"])
        text = good(draw, draw.choice([40, 80, 200])) if kind == "good" else bad(draw, kind)
        rows.append((i, text, draw.choice(["xx", "yy"]), f"s{i % 5 if i % 2 else 0}", len(text)))
        kinds[i] = kind
        labels += [(i, int(kind == "good"), 0)] if i % 3 else []
    for i in range(700, 760):  # copies and near copies of earlier rows
        doc_id, text, lang, source, _ = rows[draw.randrange(700)]
        words = text.split(" ")
        if i % 2:
            words[draw.randrange(len(words))] = "berns"
        text = "  ".join(words) if i % 4 == 0 else " ".join(words)
        rows.append((i, text, lang, source, len(text)))
        kinds[i] = kinds[doc_id]
    path = shared_path(spark, "corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, kinds


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_filter", "exact_dedup", "near_dedup", "mix_sources", "pack"]
    assert "pipeline" in contract.queries() and sum(n.startswith("op") for n in contract.queries()) >= 10


def test_each_stage_on_its_own_input(spark, folder):
    path, kinds = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        out = stage(spark, docs, path)
        if name != "pack":
            assert out.columns == columns, name
            out.write.parquet(target := shared_path(spark, name))
            docs = spark.read.parquet(target)
            after = [tuple(r) for r in docs.collect()]
            assert set(after) <= set(before) and after
        if name == "quality_filter":
            assert sum((r in set(after)) == (kinds[r[0]] == "good") for r in before) >= 0.97 * len(before)
        elif name == "exact_dedup":
            least = {}
            for r in before:
                least[normal(r[1])] = min(r[0], least.get(normal(r[1]), r[0]))
            assert sorted(r[0] for r in after) == sorted(least.values()) and len(after) < len(before)
        elif name == "near_dedup":
            want = {c for _, _, c in near_groups([r[:2] for r in before], 5, 80)}
            assert sorted(r[0] for r in after) == sorted(want) and len(after) < len(before)
        elif name == "mix_sources":
            size = Counter()
            for r in after:
                size[r[3]] += len(r[1])
            assert max(size.values()) < 1.6 * sum(size.values()) / 5  # source s0 had 60 %
            kept = after
    total = Counter()
    for r in out.collect():
        total[r["doc_id"]] += r["length"]
        assert r["offset"] + r["length"] <= 1024
    want = Counter()
    for r in kept:
        want[r[0]] += len(ids_of(r[1]))
    assert total == want


def test_run_applies_all_stages(spark, folder):
    path, _ = folder
    out = corpus_pipeline.run(spark, path)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 100


def test_empty_table(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs.write.parquet(target := shared_path(spark, name))
        out = stage(spark, spark.read.parquet(target), path)
        assert out.count() == 0 and (name == "pack" or out.columns == docs.columns)

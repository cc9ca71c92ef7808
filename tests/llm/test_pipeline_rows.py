"""The pipeline's stages on nulls, empty and long texts, repeated rows, ties and clashing columns."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adfeed.llm.common import ready, shared_path
from test_quality import good

EXTRA = ["digest", "kept", "block", "component_id", "length", "perplexity", "_source", "_steps", "_u", "_digest", "_keep", "_gone", "words"]


@pytest.fixture(scope="module")
def folder(spark):
    ready(spark)
    draw = random.Random(21)
    rows = [(i, good(draw, 60), draw.choice(["xx", None]), draw.choice(["a", "b", None]), None) for i in range(420)]
    rows += [(1000, None, "xx", "a", 1), (1001, "", None, "b", 0), (None, None, None, None, None), (1002, " \n", "xx", "a", 2)]
    rows += [rows[3]] * 3 + [(None, rows[5][1], "xx", "a", 9), (None, good(draw, 70), None, None, 5)]
    rows += [(2000, good(draw, 30_000), "xx", "b", 7), (2001, rows[8][1].replace(" ", "  "), "xx", "a", 3)]
    path = shared_path(spark, "odd-corpus")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit("x") for c in EXTRA})
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(0, 420, 2)] + [(None, 0, 1), (7, None, None), (7, 0, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_odd_rows_through_all_stages(spark, folder):
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "pack":
            assert out.columns == columns, name
        out.write.parquet(target := shared_path(spark, name))
        docs = spark.read.parquet(target)
        found[name] = docs.collect()
    empty = [r for r in found["quality_filter"] if not (r["text"] or "").strip()]
    assert len(empty) == 4  # no text is no bad text
    exact = found["exact_dedup"]
    texts = [" ".join((r["text"] or "").split()) for r in exact]
    assert sum(t == "" for t in texts) == 2  # of null and empty, and of white space alone
    assert {r["doc_id"] for r in exact if r["text"] is None or r["text"] == ""} == {1000}
    assert len(texts) - 1 == len(set(texts)) and not any(r["doc_id"] is None and r["text"] == exact[0]["text"] and exact[0]["doc_id"] is not None for r in exact[1:])
    assert {r["doc_id"] for r in found["near_dedup"]} >= {1000, 1002, 2000}
    assert all(r["digest"] == "x" and r["component_id"] == "x" for r in found["mix_sources"]) and found["pack"]
    whole = [r for r in found["mix_sources"] if r["doc_id"] == 2000]
    assert all(len(r["text"]) > 100_000 for r in whole)


def test_empty_labels(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    path = shared_path(spark, "no-labels")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    assert corpus_pipeline.quality_filter(spark, docs, path).count() == docs.count()

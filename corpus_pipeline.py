"""From raw documents to packed sequences: quality, copies, near copies, mixture, packing.

STAGES lists (name, function); each takes (spark, docs, sf_dir) and works on all that
the stage before it has kept. All but the last return the columns of documents.

Defined results. A null text counts as empty: the quality filter keeps empty texts, exact
dedup keeps one of them (the smallest doc_id; a null doc_id loses against any other), near
dedup links an empty text with nothing, mixing counts one byte for it, and packing gives it the
end token alone. Of rows that repeat doc_id and text, one stays after exact dedup. A null
language is judged by the limits of all languages, a null source is a source of its own. Ties
between near copies go to the smallest doc_id. Further columns, whatever their names, travel
through all stages but the last. Empty documents or labels give an empty result, or no limits and so no
rejects. A text of any length is read whole; its words have to fit one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adfeed.llm import exact, jaccard, mixing, packing, quality
from adfeed.llm.common import ready, shared_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under trusted text passes the limit of their language."""
    return quality.kept_rows(docs, ready(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id stays."""
    return exact.kept_rows(docs, exact.DigestIndex(ready(spark), shared_path(spark, "digest-index")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 or more in five-word shingles, the document with the smallest doc_id."""
    ready(spark)
    return jaccard.kept_rows(docs, shingle=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All sources at equal weight; a repeated document is a row for each copy."""
    ready(spark)
    return mixing.mixed_sources(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    ready(spark)
    return packing.packed(docs, tokens=1024)


STAGES = [
    ("quality_filter", quality_filter),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

# A trained model and a tokenizer decide; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Counters and samples of a capture log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adfeed.functions.text import strip_json_guard

# Address part of wanted responses, and the size of a diagnostic sample.
RESPONSE_URL_PARTS = ["/api/graphql/"]
SAMPLES_PER_GROUP = 3
SAMPLE_CHARS = 5000


def capture_counts(
    responses: DataFrame, by: Sequence[str] = ("groupe_id", "step"),
    url_parts: Sequence[str] = tuple(RESPONSE_URL_PARTS), posts: DataFrame | None = None,
) -> DataFrame:
    """Responses seen, responses of the wanted kind and, given the posts found, their number."""
    wanted = F.lit(False)
    for part in url_parts:
        wanted = wanted | F.coalesce(F.col("url").contains(part), F.lit(False))
    counts = responses.groupBy(*by).agg(
        F.count("*").alias("reponses_vues"), F.count_if(wanted).alias("reponses_retenues")
    )
    if posts is None:
        return counts
    found = posts.groupBy(*by).agg(F.count("*").alias("nb_posts"))
    return counts.join(found, list(by), "full_outer").na.fill(0, ["reponses_vues", "reponses_retenues", "nb_posts"])


def oldest_in_step(new_posts: DataFrame, by: Sequence[str] = ("groupe_id", "step")) -> DataFrame:
    """Oldest known publication date of the new posts of a step; NULL if all are undated."""
    return new_posts.groupBy(*by).agg(F.min("date_publication").alias("plus_ancien"))


def empty_group_samples(
    responses: DataFrame, records: DataFrame, order: Sequence[str],
    limit: int = SAMPLES_PER_GROUP, chars: int = SAMPLE_CHARS,
) -> DataFrame:
    """For groups that had responses but no record: their first bodies, cut for reading."""
    empty = responses.join(records.select("groupe_id").distinct(), "groupe_id", "left_anti")
    ranked = empty.withColumn(
        "rang", F.row_number().over(Window.partitionBy("groupe_id").orderBy(*order))
    ).filter(F.col("rang") <= limit)
    return ranked.select(
        "groupe_id", "rang", "url", F.substring(strip_json_guard(F.col("body")), 1, chars).alias("corps_tronque")
    )

"""Newest known post per group: where the next run may stop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_markers(old: DataFrame, new: DataFrame) -> DataFrame:
    """A new marker replaces the old one only if it is not empty."""
    fresh = new.select("groupe_id", F.when(F.col("post_id") != "", F.col("post_id")).alias("_nouveau"))
    merged = old.join(fresh, "groupe_id", "full_outer")
    return merged.select("groupe_id", F.coalesce("_nouveau", "post_id").alias("post_id")).filter(
        "post_id IS NOT NULL"
    )


def with_marker(groups: DataFrame, markers: DataFrame) -> DataFrame:
    """Every group with its marker, NULL on the first visit."""
    return groups.join(markers, "groupe_id", "left")

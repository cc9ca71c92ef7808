"""The list of followed groups."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeed.functions.text import strip

# Fixed values.
REQUIRED_COLUMNS = ["id", "nom", "url", "actif"]
TRUE_WORDS = ["1", "true", "vrai", "oui"]
PLACEHOLDER_PREFIX = "TODO"


def load_groups(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Active groups of a CSV file with a header; extra columns are ignored.

    Raises FileNotFoundError for a missing file and ValueError for a wrong
    header or a file without an active group.
    """
    try:
        raw = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise
    missing = [c for c in REQUIRED_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"{path}: columns missing from the header: {missing}")
    # One task reads a file with line breaks in cells from start to end, so ids follow the file.
    groups = active_groups(raw.withColumn("_pos", F.monotonically_increasing_id()), limit)
    if groups.isEmpty():
        raise ValueError(f"{path}: no active group")
    return groups


def active_groups(raw: DataFrame, limit: int | None = None) -> DataFrame:
    """Trimmed active groups without placeholder rows, the first ``limit`` by ``_pos`` if given."""
    trimmed = raw.select(*[strip(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in REQUIRED_COLUMNS], "_pos")
    groups = trimmed.filter(~F.upper("id").startswith(PLACEHOLDER_PREFIX)).withColumn(
        "actif", F.lower("actif").isin(*TRUE_WORDS)
    )
    active = groups.filter("actif")
    first = active.orderBy("_pos").limit(limit) if limit and limit > 0 else active
    return first.drop("_pos")

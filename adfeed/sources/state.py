"""Collection state: seen ids, markers, health scores, the master and the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adfeed.operators.seen import days_of
from adfeed.operators.upsert import merge_lots
from adfeed.schemas import HEALTH, MARKERS, MASTER, RUNS, SEEN
from adfeed.sources import journal
from adfeed.sources.tables import folders, path_exists, read_table


SKETCHES = "_esquisses"  # beside the days; readers of the folder pass it over


def load_seen(spark: SparkSession, path: str, only: DataFrame | None = None) -> DataFrame:
    """The seen ids; empty before the first run. They lie in one folder for each day.

    ``only``: rows with an ``id``. Days whose sketch holds none of these ids are not read; a day
    without a sketch is.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], SEEN)
    if only is None:
        return spark.read.schema(SEEN).parquet(path).select(*SEEN.fieldNames())
    days = {name for name in folders(spark, path) if name.startswith("jour=")}
    sketched = days.intersection(folders(spark, f"{path}/{SKETCHES}"))
    wanted = days - sketched
    if sketched:
        stored = spark.read.schema("jour STRING, seau BIGINT, bits BINARY").parquet(f"{path}/{SKETCHES}")
        wanted |= {f"jour={r['jour']}" for r in days_of(only, stored, "jour").collect()} & sketched  # a row for each day at most
    if not wanted:
        return spark.createDataFrame([], SEEN)
    return spark.read.schema(SEEN).parquet(*[f"{path}/{name}" for name in sorted(wanted)]).select(*SEEN.fieldNames())


def load_markers(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, MARKERS)


def load_health(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest score of every source."""
    return merge_lots(journal.lots(spark, path, HEALTH, version), "source", ())


def load_master(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The master as of a version (the newest): its lots merged by id."""
    return merge_lots(journal.lots(spark, path, MASTER, version))


def load_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run log; empty before the first run."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], RUNS)
    return spark.read.schema(RUNS).parquet(path)

"""Small state tables kept as numbered parquet snapshots: ``<path>/v=<n>``.

A snapshot is written whole and counts once Spark has committed it (``_SUCCESS``), so readers
never see half a table. The last ``KEPT_VERSIONS`` stay. Tables that grow are journals
(``adfeed.sources.journal``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

KEPT_VERSIONS = 7


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _file_system(spark, path)
    return files.exists(hadoop_path)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed snapshots, oldest first."""
    return sorted(n for n in _numbers(spark, path) if path_exists(spark, f"{path}/v={n}/_SUCCESS"))


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(name[2:]) for name in folders(spark, path) if name.startswith("v=") and name[2:].isdigit()]


def read_table(spark: SparkSession, path: str, schema: StructType, version: int | None = None) -> DataFrame:
    """The given or newest snapshot; an empty table where there is none yet.

    Damaged files raise: forgetting a state would bring every old post back.
    """
    known = versions(spark, path)
    if version is not None:
        known = [n for n in known if n <= version]
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/v={known[-1]}")


def write_table(df: DataFrame, path: str, version: int | None = None) -> int:
    """Write the next (or the given) snapshot and return its number."""
    spark = df.sparkSession
    if version is None:
        known = versions(spark, path)
        version = known[-1] + 1 if known else 0
    df.write.mode("overwrite").parquet(f"{path}/v={version}")
    for number in _numbers(spark, path):
        if number <= version - KEPT_VERSIONS:
            delete_folder(spark, f"{path}/v={number}")
    return version


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    files, folder = _file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()] if files.exists(folder) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    files, folder = _file_system(spark, path)
    files.delete(folder, True)

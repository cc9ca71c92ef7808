"""Session settings and the shared work folder."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the operators rely on. All of them can be set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Post-level joins meet hot groups: AQE splits them at run time, also where a
    # later step would have liked to reuse the partitioning.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # 90 days of post ids do not fit into the heap of an executor.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply RUNTIME_CONF to an existing session and return it.

    Python functions of this package travel to the workers inside the tasks, so
    that the package need not be installed there.
    """
    cloudpickle.register_pickle_by_value(sys.modules["adfeed"])
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", shared: str | None = None
) -> SparkSession:
    """Single-machine session for tests and the benchmark; ``shared``: its folder for intermediate tables."""
    settings = {"spark.checkpoint.dir": shared} if shared else {}
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("adfeed")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config(map=settings)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``.

    Without that setting a local session uses its warehouse; on a cluster that may be a
    folder of one machine, so the setting is required there. What a session has put there
    goes when the session ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors reach")
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir')}/_travail"
    own = f"{root.rstrip('/')}/adfeed/{spark.sparkContext.applicationId}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return f"{own}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write an intermediate result once, so that its readers do not compute it again.

    A table in the shared folder survives the loss of executors, is read column
    by column, and tells the planner its true size: a small one may be broadcast,
    a large one will not.
    """
    path = work_folder(df.sparkSession, "etape")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal a small input to all cores before a step that is costly for each row.

    A table smaller than one scan block for each core leaves cores without a task, and a file of
    one row group is one task whatever its splits. A larger table fills the cores by itself
    and is left as it is: its rows are not shuffled. ``spark.adfeed.spread=false`` leaves
    every input as it is.
    """
    spark = df.sparkSession
    if df.isStreaming or spark.conf.get("spark.adfeed.spread", "true") != "true":
        return df
    cores = spark.sparkContext.defaultParallelism
    block = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * block else df


def with_computed(df: DataFrame, name: str, col: Column) -> DataFrame:
    """Add a costly column that is computed once per row.

    As a plain column it would be copied into every later filter and condition
    that uses it, and be computed for each; a generator is not pushed around.
    """
    return df.select("*", F.explode(F.array(col)).alias(name))

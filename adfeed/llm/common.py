"""What several operators share: work tables, word hashes, connected components."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeed.session import work_folder

# Fixed value: the white space of all word rules, as a class of Java patterns.
SPACE = r"[\x20\x09-\x0D]"

# Rows and bytes of one Arrow batch: a Python worker holds a few of them.
BATCH_ROWS, BATCH_BYTES = "1000", str(8 << 20)


def ready(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on; their functions travel inside the tasks."""
    cloudpickle.register_pickle_by_value(sys.modules["adfeed"])
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder in the shared folder that ``spark.checkpoint.dir`` names."""
    return work_folder(spark, purpose)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, stored once as a table in the shared folder.

    Later jobs read the table and neither compute the rows again nor depend on
    any executor that took part in making them.
    """
    path = shared_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, purpose: str) -> DataFrame:
    """As ``written``, in buckets of ``key``: joins on it leave this side where it is."""
    spark = df.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_path(spark, purpose)
    table = "llm_" + path.rsplit("-", 1)[1]
    df.repartition(count, key).write.bucketBy(count, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)


def without(df: DataFrame, *names: str) -> DataFrame:
    """The rows without columns that an operator is about to add (any case)."""
    taken = {n.lower() for n in names}
    return df.select(*[c for c in df.columns if c.lower() not in taken])


def free_name(df: DataFrame, name: str) -> str:
    """The name, or a longer one that no column of the rows has (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rows_of(make: Callable, schema: pa.Schema) -> Callable:
    """A function for mapInArrow out of ``make(columns) -> {name: values}``.

    ``columns`` are the batch's columns by name. A batch without rows is passed over.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = make({name: batch.column(i) for i, name in enumerate(batch.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return run


def task(run: Callable) -> Callable:
    """The function for one task, which hands its memory back at the end: workers live on and their tasks differ."""

    def tidy(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if trim:
            trim(0)

    return tidy


class WordHashes(dict):
    """Word (UTF-8 bytes) to 64-bit hash. The first ``limit`` words are remembered."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.limit:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def lower_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lowered. ``bytes.split`` parts at SPACE exactly."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """One hash for each run of ``length`` consecutive word hashes."""
    count = len(words) - length + 1
    if count < 1:
        return np.empty(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for i in range(length):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + count])
    return out


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """node, component (smallest node within reach) for pairs ``a``, ``b``.

    Alternates the large-star and small-star steps until nothing changes. Every
    step keeps at most as many pairs as there were, minima are combined before
    the shuffle, a hub's pairs are split by the skew join, and each round is a
    table of its own. Pairs with a null or with twice the same node are ignored.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = written(pairs, purpose)
    before = None
    while True:
        both = pairs.union(pairs.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        pairs = written(small.where("u <> v").distinct(), purpose)
        state = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    nodes = edges.where("a <> b").select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return nodes.join(pairs.withColumnsRenamed({"u": "node", "v": "component"}), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def octets(text: Column | str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")

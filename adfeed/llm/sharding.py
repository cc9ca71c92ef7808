"""Two-pass external shuffle into shards, in DataFrame operations only.

Pass one scatters the rows over buckets by a seeded hash; the number of buckets
follows from the bytes, so that a bucket fits into a task's memory at any size of
the input. Pass two shuffles each bucket by Fisher-Yates (``shuffle`` with a
seed). The buckets, one after the other, are the shuffled collection, which is
cut into shards whose row counts differ by one at most.

Bucket b is partition b and is sorted before it is shuffled, so that the order
depends on rows and seed alone: a task that runs again, or a cluster of another
size, gives the same one.

Defined results. A null text has no bytes; null ids and repeated ids are rows like
any other (the text takes part in the hash); fully identical rows share a bucket.
An empty table gives no rows. Columns of the input named like the added ones are
replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adfeed.llm.common import octets, without, written

LAW = "rows"


def shuffled_shards(
    docs: DataFrame, shards: int = 16, bucket_bytes: int = 32 << 20, seed: int = 17, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows with ``shard``, ``slot`` (place in the shard) and ``law``."""
    docs = without(docs, "shard", "slot", "law")
    key = F.xxhash64(F.lit(seed), F.col(id_column), F.col(text_column))
    total = docs.agg(F.count("*").alias("rows"), F.sum(octets(text_column) + 1).alias("bytes")).first()
    rows, buckets = total["rows"], max(1, -(-(total["bytes"] or 0) // bucket_bytes))
    bucket = F.pmod(key, F.lit(buckets)).cast("int")

    # Where each bucket starts: one row per bucket, not per document.
    counts = written(docs.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")), "buckets")
    before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    starts = counts.select(F.col("bucket").alias("b"), before.alias("start"))

    scattered = docs.select(bucket.alias("bucket"), F.struct(key.alias("key"), F.struct(*docs.columns).alias("row")).alias("r"))
    ordered = scattered.repartitionById(buckets, "bucket").groupBy("bucket").agg(F.sort_array(F.collect_list("r")).alias("r"))
    placed = ordered.select("bucket", F.posexplode(F.shuffle("r", F.lit(seed))).alias("pos", "r"))
    place = F.col("start") + F.col("pos")
    shard = F.expr(f"(start + pos) * {shards}L div {max(rows, 1)}L")
    joined = placed.join(starts, placed["bucket"] == starts["b"]).select(F.col("r.row").alias("row"), shard.cast("int").alias("shard"), place.alias("place"))
    first = F.expr(f"(shard * {rows}L + {shards - 1}L) div {shards}L")
    return joined.select("row.*", "shard", (F.col("place") - first).alias("slot"), F.lit(LAW).alias("law"))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder per shard. A task holds a stretch of one or two shards in order, so nothing is shuffled again."""
    shuffled.write.partitionBy("shard").parquet(path)

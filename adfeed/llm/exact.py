"""Exact deduplication against a persistent digest index.

The index is a parquet table, bucketed and sorted by digest, in a folder that
outlives the session. A batch of documents is reduced to one row per digest
before anything is shuffled, joined with the index by a sort-merge anti-join
(only the batch moves: the index already lies in its buckets), and what is new
is appended under the name of the batch. A batch that is run again under its name is
held against the others only and adds what its first run did not: its answers are those
of the first run.

Defined results. A null text counts as empty, and all empty texts are equal. Of
equal texts the smallest doc_id stays; a null doc_id loses against any other. Of
rows that repeat both doc_id and text, one stays. A text that an earlier batch
has brought stays with that batch. An empty batch changes nothing. Other
columns, whatever their names, are carried by ``kept_rows`` and ignored otherwise.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeed.llm.common import SPACE, free_name, written


def text_sha256(text: Column) -> Column:
    """Lowercase hex SHA-256 of a text whose runs of white space are one space each."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " "), 256)


class DigestIndex:
    """digest, keep_id, batch: one row for every distinct text seen so far.

    ``buckets``: fixed when the index is made; as many as shuffle partitions, 64 at least, where not given.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.table = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
        location = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest STRING, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{location}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def unseen(self, digests: DataFrame, batch: str) -> DataFrame:
        """The digests that no other batch has brought."""
        return digests.hint("merge").join(self.read().where(F.col("batch") != batch), "digest", "left_anti")

    def append(self, fresh: DataFrame, batch: str) -> None:
        """One sorted file per bucket. Rows that the batch has added before are not added again."""
        new = fresh.select("digest", "keep_id").hint("merge").join(self.read().where(F.col("batch") == batch), "digest", "left_anti")
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))  # as the table's writer computes it
        new = written(new, "new")  # the table is read above
        new.select("digest", "keep_id", F.lit(batch)).repartition(self.buckets, bucket).write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)


def exact_duplicates(docs: DataFrame, index: DigestIndex, id_column: str = "doc_id", text_column: str = "text", batch: str | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of the batch.

    ``batch`` names it, so that it can be run again; without a name it is one of its own.

    group_size counts the rows of this batch. Texts do not travel: rows are
    reduced to (digest, doc_id, number of repetitions) next to the scan.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_sha256(F.col(text_column)).alias("digest"))
    rows = written(rows.groupBy("digest", "doc_id").agg(F.count("*").alias("n")), "digests")
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
    batch = batch or uuid.uuid4().hex
    fresh = written(index.unseen(groups, batch), "fresh")
    index.append(fresh, batch)
    first = fresh.select("digest", F.lit(True).alias("first"))
    answers = groups.drop("keep_id").join(index.read().drop("batch"), "digest").join(first, "digest", "left")
    copies = rows.join(answers, "digest").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    stays = F.coalesce("first", F.lit(False)) & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return copies.select("doc_id", "keep_id", "group_size", stays.alias("kept"), F.col("digest").alias("text_sha256"))


def kept_rows(docs: DataFrame, index: DigestIndex, id_column: str = "doc_id", text_column: str = "text", batch: str | None = None) -> DataFrame:
    """The rows of the batch whose texts stay, with all their columns."""
    verdicts = exact_duplicates(docs, index, id_column, text_column, batch).where("kept")
    digest, keep = free_name(docs, "_digest"), free_name(docs, "_keep")
    winners = verdicts.select(F.col("text_sha256").alias(digest), F.col("doc_id").alias(keep))
    tagged = docs.withColumn(digest, text_sha256(F.col(text_column)))
    same = (tagged[digest] == winners[digest]) & tagged[id_column].cast("long").eqNullSafe(winners[keep])
    return tagged.join(winners, same, "left_semi").dropDuplicates([digest]).select(*docs.columns)

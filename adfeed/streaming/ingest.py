"""Continuous ingest of raw posts into the master table.

Every sink here is a journal (``adfeed.sources.journal``) that holds, beside its rows, the last
batch of each query that writes to it. A query is named by a note in its checkpoint folder. So a
batch that is run again adds nothing, and a query with a new checkpoint on an old table counts its
batches for itself and overwrites none of the others'.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from adfeed.operators.health import source_health
from adfeed.operators.seen import RETENTION_DAYS
from adfeed.sinks.tables import save_health, upsert_master
from adfeed.sources import journal
from adfeed.sources.state import load_health
from adfeed.sources.tables import path_exists

NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
RETENTION = timedelta(days=RETENTION_DAYS)


def read_new_files(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """Stream of the parquet files that appear in a folder, each read once."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)


def query_name(spark: SparkSession, checkpoint: str) -> str:
    """The name under which a query marks its batches, fixed when it first starts."""
    note = f"{checkpoint}/nom"
    journal.create_if_absent(spark, note, uuid.uuid4().hex)
    return journal.read_text(spark, note)


def _each_batch(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, journal.Mark], None]) -> StreamingQuery:
    """Run ``write(batch, mark)`` for the input there is, then stop."""
    spark = stream.sparkSession
    name = query_name(spark, checkpoint)
    writer = stream.writeStream.foreachBatch(lambda batch, number: write(batch, (name, number)))
    # State that goes by processing time would call for batches without data for ever; a query takes the setting over at its start.
    before = spark.conf.get(NO_DATA)
    spark.conf.set(NO_DATA, "false")
    try:
        return writer.option("checkpointLocation", f"{checkpoint}/flux").trigger(availableNow=True).start()
    finally:
        spark.conf.set(NO_DATA, before)


# Ids that share a piece of state: one call of Python and one state value serve all that meet in a batch.
BUCKETS = 1 << 12


def _id_key(posts: DataFrame, id_col: str) -> Column:
    """An id as a text, another one for every id."""
    kind, col = posts.schema[id_col].dataType, F.col(id_col)
    if isinstance(kind, BinaryType):
        return F.hex(col)
    return F.when(col.isNotNull(), F.to_json(F.struct(col))) if isinstance(kind, (ArrayType, StructType)) else col.cast("string")


def _first_sightings(order: Sequence[str], retention: timedelta) -> Callable:
    """Of each id and batch the first row, unless the id was seen within the retention.

    The state of a bucket holds for each of its ids the time of its first sighting, and when that
    goes: when the retention has passed since it was written, whether or not the id comes again.
    """
    micros = retention // timedelta(microseconds=1)

    def place(row: dict) -> list:
        return [(row[c] is not None, row[c]) for c in order]

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        held = {name: (at, until) for name, at, until in json.loads(state.get[0])} if state.exists else {}
        firsts, told = {}, {}
        for part in () if state.hasTimedOut else parts:  # rows of a bucket come in parts; only the first one of each id is held
            for name, row, seen, known in zip(part["_cle"], part["_ligne"], part["_vu_us"], part["_connu"]):
                seen = None if pd.isna(seen) else int(seen)
                if known:
                    told[name] = (seen, now + micros // 1000)
                elif name not in firsts or place(row) < place(firsts[name][0]):
                    firsts[name] = (row, seen)
        kept = {name: entry for name, entry in held.items() if entry[1] > now or name in firsts} | told
        new = []
        for name, (row, seen) in firsts.items():
            at, until = kept.get(name, (None, None))
            if until is None or at is not None and seen is not None and seen - at > micros:
                kept[name] = (seen, now + micros // 1000)
                new.append(row)
        if new:
            yield pd.DataFrame({"_ligne": new})
        if kept:
            state.update((json.dumps([(name, *entry) for name, entry in kept.items()]),))
            state.setTimeoutDuration(max(1, min(until for _, until in kept.values()) - now))
        elif state.exists:
            state.remove()

    return run


def first_post_stream(
    posts: DataFrame, out: str, checkpoint: str, order: Sequence[str] = ("_pos",), id_col: str = "id",
    seen_at: str | None = None, retention: timedelta = RETENTION,
) -> StreamingQuery:
    """Append the first row of every id to the journal ``out``; stops when the input is used up.

    The ids live in the state store, so a batch reads no earlier output; those of one of ``BUCKETS``
    hash values share an entry there, which is written anew when one of them comes. There is no watermark:
    late rows and rows without a time are treated like any other. ``seen_at`` names the time a
    row was captured; an id comes again if that is more than ``retention`` after its first
    sighting. Without it, or without a time in the row, the time of processing counts.

    A query with a new checkpoint starts from the ids that the output holds: they are noted in
    the checkpoint folder and are part of its first batch. The number of state partitions is that
    of shuffle partitions when the query first starts. A checkpoint whose state holds an entry for
    each id (written by earlier versions) can't go on: start a new one on the old output.
    """
    spark = posts.sparkSession
    at = (F.unix_micros(F.col(seen_at).cast("timestamp")) if seen_at else F.lit(None)).cast("long").alias("_vu_us")
    note, kind = f"{checkpoint}/connus", StructType([posts.schema[id_col], StructField("_vu_us", LongType())])
    if not path_exists(spark, f"{note}/_SUCCESS"):
        before = journal.read(spark, out, posts.schema).select(id_col, at)
        before.groupBy(id_col).agg(F.max("_vu_us").alias("_vu_us")).write.mode("overwrite").parquet(note)
    line, name = F.struct(*posts.columns), _id_key(posts, id_col).alias("_cle")
    rows = posts.select(name, at, F.lit(False).alias("_connu"), line.alias("_ligne"))
    known = spark.readStream.schema(kind).parquet(note)
    known = known.select(name, "_vu_us", F.lit(True).alias("_connu"), F.lit(None).cast(rows.schema["_ligne"].dataType).alias("_ligne"))
    bucket = F.pmod(F.xxhash64("_cle"), F.lit(BUCKETS))
    kept = rows.union(known).withColumn("_lot", bucket).groupBy("_lot").applyInPandasWithState(
        _first_sightings(list(order), retention), StructType([rows.schema["_ligne"]]), "ids STRING", "append", GroupStateTimeout.ProcessingTimeTimeout
    ).select("_ligne.*")

    def write(batch: DataFrame, mark: journal.Mark) -> None:
        if journal.state(spark, out).has(mark):
            batch.write.format("noop").mode("overwrite").save()  # the state store has to take the batch in again
            return
        journal.append(batch, out, mark)
        journal.compact(spark, out, posts.schema, journal.appended)

    return _each_batch(kept, checkpoint, write)


def upsert_stream(
    posts: DataFrame, master_path: str, checkpoint: str, now: datetime | None = None, order: tuple[str, ...] = ("_pos",)
) -> StreamingQuery:
    """Upsert every micro-batch into the master; stops when the input is used up."""

    def write(batch: DataFrame, mark: journal.Mark) -> None:
        upsert_master(batch, master_path, now or datetime.now().astimezone(), list(order), mark)

    return _each_batch(posts, checkpoint, write)


def score_stream(runs: DataFrame, health_path: str, checkpoint: str) -> StreamingQuery:
    """Carry the reliability score of every source forward with each batch of new runs."""
    spark = runs.sparkSession

    def write(batch: DataFrame, mark: journal.Mark) -> None:
        while not (now := journal.state(spark, health_path)).has(mark):
            before = load_health(spark, health_path, now.version)
            try:
                save_health(source_health(batch, before), health_path, mark, now.version)
            except journal.Outdated:  # another query wrote meanwhile: go on from its scores
                continue

    return _each_batch(runs, checkpoint, write)

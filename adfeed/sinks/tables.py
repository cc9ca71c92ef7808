"""Tables for later runs: raw posts, run log, master, seen ids, markers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfeed.operators.dedup import dedup_last
from adfeed.operators.markers import merge_markers
from adfeed.operators.seen import RETENTION_DAYS, first_sightings, seen_at, sketch, unseen
from adfeed.operators.upsert import merge_lots
from adfeed.schemas import HEALTH, MASTER
from adfeed.session import cut_lineage
from adfeed.sources import journal
from adfeed.sources.state import SKETCHES, load_markers, load_seen
from adfeed.sources.tables import delete_folder, folders, write_table


def append_raw(posts: DataFrame, path: str, run_ts: str, order: Sequence[str] = ("_pos",)) -> None:
    """Append the posts of a run, one folder per run and group; nothing for no posts.

    Rows meet by group, so a small group is one file; the rebalancing splits a large one.
    """
    stamped = posts.withColumn("run_ts", F.lit(run_ts)).hint("rebalance", "groupe_id")
    stamped.sortWithinPartitions("groupe_id", *order).write.mode("append").partitionBy("run_ts", "groupe_id").parquet(path)


def log_run(run: DataFrame, path: str) -> None:
    """Append a run-log row. Call it last, so that a failed run leaves none."""
    run.write.mode("append").partitionBy("mode").parquet(path)


def upsert_master(batch: DataFrame, path: str, now: datetime, order: Sequence[str], mark: journal.Mark | None = None) -> int | None:
    """Add a batch to the master and return its version; an empty batch adds none.

    Of an id that the batch repeats, the last row by ``order`` counts.  The batch alone is
    read and written: ids meet their earlier rows when the table is read, and when lots are
    merged.  ``mark`` names the batch of a streaming query, which counts once.
    """
    names = [c for c in batch.columns if c in MASTER.fieldNames() or c in order]
    full = batch.select(
        *names, *[F.lit(None).cast(f.dataType).alias(f.name) for f in MASTER.fields if f.name not in names]
    ).withColumn("date_incertaine", F.coalesce(F.col("date_incertaine").cast("boolean"), F.lit(False)))
    latest = dedup_last(full.filter("id IS NOT NULL"), "id", order)
    stamped = latest.withColumns({"premiere_collecte": F.lit(now), "derniere_maj": F.lit(now)}).select(*MASTER.fieldNames())
    version = journal.append(stamped, path, mark)
    journal.compact(batch.sparkSession, path, MASTER, merge_lots)
    return version


def save_seen(new_posts: DataFrame, path: str, now: datetime, days: int = RETENTION_DAYS) -> None:
    """Add the ids that are new, and forget the days before the retention.

    Only new ids are written, into the folder of the day they were first seen: ids meet by
    day, and a day of many ids is split over tasks. A sketch of each day tells later runs
    which days to look into. Old days go as folders. Ids with an unreadable date stay.
    """
    spark = new_posts.sparkSession
    first = first_sightings(new_posts)
    day = F.coalesce(F.date_format(seen_at(), "yyyy-MM-dd"), F.lit("inconnu"))
    added = cut_lineage(unseen(first, load_seen(spark, path, first)).withColumn("jour", day))
    # The sketch comes first: a bit without its id costs a look, an id without its bit would come again.
    sketch(added, "jour").write.mode("append").partitionBy("jour").parquet(f"{path}/{SKETCHES}")
    added.hint("rebalance", "jour").write.mode("append").partitionBy("jour").parquet(path)
    oldest = (now - timedelta(days=days)).strftime("%Y-%m-%d")
    for place in (path, f"{path}/{SKETCHES}"):
        for name in folders(spark, place):
            if "jour=0" < name < f"jour={oldest}":
                delete_folder(spark, f"{place}/{name}")


def save_markers(new: DataFrame, path: str) -> int:
    return write_table(merge_markers(load_markers(new.sparkSession, path), new), path)


def save_health(health: DataFrame, path: str, mark: journal.Mark | None = None, expected: int | None = None) -> int | None:
    """Keep the scores of this run; sources without a run keep their old one.

    ``expected``: the version the scores go on from; ``journal.Outdated`` is raised where it is not the newest.
    """
    version = journal.append(health.select(*HEALTH.fieldNames()), path, mark, expected)
    journal.compact(health.sparkSession, path, HEALTH, lambda lots: merge_lots(lots, "source", ()))
    return version

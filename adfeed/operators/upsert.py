"""Insert-or-update by id into the master table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeed.operators.dedup import dedup_last


def merge_batch(
    master: DataFrame, batch: DataFrame, now: Column | datetime, order: Sequence[str] | None = None
) -> DataFrame:
    """The master after a batch.

    A known id takes all business columns of the batch and keeps its
    ``premiere_collecte``; a new id is added; both get ``derniere_maj = now``.
    With ``order`` the last row of an id in the batch wins; without it the batch
    must already hold each id once.

    Untouched rows pass through a single anti join: as long as the batch ids are
    small enough for a broadcast the master is never shuffled.
    """
    at = now if isinstance(now, Column) else F.lit(now)
    named = batch.filter("id IS NOT NULL")
    if order:
        named = dedup_last(named, "id", order)
    business = [c for c in master.columns if c not in ("premiere_collecte", "derniere_maj")]
    latest = named.select(*business)
    ids = latest.select("id")
    first_seen = master.select("id", "premiere_collecte").join(ids, "id", "left_semi")
    written = (
        latest.join(first_seen, "id", "left")
        .withColumn("premiere_collecte", F.coalesce("premiere_collecte", at))
        .withColumn("derniere_maj", at)
    )
    return master.join(ids, "id", "left_anti").unionByName(written.select(*master.columns))


def merge_lots(lots: Sequence[DataFrame], key: str = "id", keep_first: Sequence[str] = ("premiere_collecte",)) -> DataFrame:
    """The table that lots make up, the oldest first; each holds a key once.

    The youngest row of a key counts; ``keep_first`` columns come from its oldest one. The
    oldest lot, which holds most rows, is read in place: its rows pass through one anti join
    with the keys of the younger lots, and is not shuffled while those fit a broadcast.
    """
    oldest, younger = lots[0], lots[1:]
    if not younger:
        return oldest
    stacked = [lot.withColumn("_rang", F.lit(i)) for i, lot in enumerate(younger)]
    whole = stacked[0]
    for lot in stacked[1:]:
        whole = whole.unionByName(lot)
    values = [c for c in oldest.columns if c != key]
    grouped = whole.groupBy(key).agg(
        F.max_by(F.struct(*values), "_rang").alias("_valeurs"), *[F.min_by(c, "_rang").alias(f"_{c}") for c in keep_first]
    )
    latest = grouped.select(key, *[F.col(f"_{c}" if c in keep_first else f"_valeurs.{c}").alias(c) for c in values])
    keys = latest.select(key)
    if keep_first:
        first = oldest.join(keys, key, "left_semi").select(key, *[F.col(c).alias(f"_{c}") for c in keep_first])
        latest = latest.join(first, key, "left").withColumns({c: F.coalesce(f"_{c}", c) for c in keep_first})
    return oldest.join(keys, key, "left_anti").unionByName(latest.select(*oldest.columns))


def latest_first(master: DataFrame) -> DataFrame:
    """Consultation order: newest update first, then id."""
    return master.orderBy(F.desc("derniere_maj"), "id")

"""Run log, volume drift and run summary."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adfeed.functions.text import mask_credentials
from adfeed.session import cut_lineage

# Drift thresholds.
HISTORY = 7
MIN_HISTORY = 3
LOW_RATIO = 0.3


def densify_days(counts: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """Every key on every day from its own first one to the last of all, absent days as 0.

    A day without results is the signal drift detection looks for, so it has to be a
    row; days before a key's first are none.  Days come from a generator per key, not
    from a join.  ``counts`` is one row per key and day; it is written once, as it is
    read twice.
    """
    counts = cut_lineage(counts)
    end = counts.agg(F.max(day).alias("fin")).select("fin").scalar()
    zeros = counts.groupBy(*keys).agg(F.min(day).alias("_debut")).select(
        *keys, F.explode(F.sequence("_debut", end)).alias(day), F.lit(0).cast("bigint").alias(value)
    )
    return counts.select(*keys, day, value).unionByName(zeros).groupBy(*keys, day).agg(
        F.sum(value).alias(value)
    )


def _verdict(count: Column, mean: Column, history: Column, min_history: int, ratio: float) -> Column:
    return F.coalesce((history >= min_history) & (mean > 0) & (count < mean * ratio), F.lit(False))


def drift_message(count: Column, mean: Column, history: Column) -> Column:
    """Text of an alert; ties are rounded to even."""
    return F.format_string(
        "Low volume: %d valid ads against %.1f on average over the last %d daily runs (%.0f%% of the mean)",
        count.cast("bigint"), F.bround(mean, 1), history.cast("bigint"), F.bround(100 * count / mean, 0),
    )


def volume_drift(
    runs: DataFrame,
    source: Sequence[str] = ("source",),
    at: str = "horodatage",
    count: str = "nb_valides",
    window: int = HISTORY,
    ratio: float = LOW_RATIO,
    min_history: int = MIN_HISTORY,
) -> DataFrame:
    """Daily runs with the mean of the runs before them and an alert flag.

    The run itself is not part of its history.  Other modes do not take part,
    neither as runs nor as history.
    """
    daily = runs.filter("mode = 'daily'") if "mode" in runs.columns else runs
    before = Window.partitionBy(*source).orderBy(at).rowsBetween(-window, -1)
    scored = daily.withColumn("moyenne", F.avg(count).over(before)).withColumn(
        "nb_historique", F.count(count).over(before)
    )
    return scored.withColumn(
        "alerte", _verdict(F.col(count), F.col("moyenne"), F.col("nb_historique"), min_history, ratio)
    )


def drift_intervals(
    counts: DataFrame,
    source: Sequence[str] = ("source",),
    day: str = "horodatage",
    count: str = "nb_valides",
    window: int = HISTORY,
    ratio: float = LOW_RATIO,
    min_history: int = MIN_HISTORY,
) -> DataFrame:
    """Alerts of daily counts as stretches of days: source, debut, fin, nb_valides, moyenne, nb_historique.

    The alerts are those of ``volume_drift`` over ``densify_days``, but a silent day is no row: the
    history of a day is a range of days, and a gap between two days with results is one stretch
    of alerts at most, which ends when the history has nothing but zeros. So a wrong date, however
    far off, adds no rows. ``counts`` is one row per source and day, none of them negative. The
    means of a silent stretch differ by day and are NULL.
    """
    number = F.datediff(F.col(day).cast("date"), F.lit("1970-01-01").cast("date"))
    end = counts.agg(F.max(number).alias("fin")).select("fin").scalar()
    ordered = Window.partitionBy(*source).orderBy("_jour")
    until = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = counts.select(*source, number.alias("_jour"), F.col(count).alias("nb_valides")).select(
        "*",
        F.coalesce(F.sum("nb_valides").over(ordered.rangeBetween(-window, -1)), F.lit(0)).alias("_somme"),
        (F.col("_jour") - F.min("_jour").over(until)).alias("_age"),
        F.lead("_jour").over(ordered).alias("_suivant"),
        F.max(F.when(F.col("nb_valides") > 0, F.col("_jour"))).over(until).alias("_dernier"),
    ).withColumn("_fin", F.coalesce("_suivant", end + 1) - 1)
    history = F.least(F.lit(window), F.col("_age"))
    mean = F.when(history > 0, F.col("_somme") / history)
    low = _verdict(F.col("nb_valides"), mean, history, min_history, ratio)
    own = days.filter(low).select(*source, F.col("_jour").alias("_debut"), F.col("_jour").alias("_fin"), "nb_valides", mean.alias("moyenne"), history.alias("nb_historique"))
    begin = F.col("_jour") + F.greatest(F.lit(1), min_history - F.col("_age"))
    stop = F.least("_fin", F.col("_dernier") + window)
    nothing = F.lit(None).cast("double").alias("moyenne"), F.lit(None).cast("int").alias("nb_historique")
    silent = days.filter(F.col("_dernier").isNotNull() & (begin <= stop) & F.lit(ratio > 0)).select(*source, begin.alias("_debut"), stop.alias("_fin"), F.lit(0).cast("bigint").alias("nb_valides"), *nothing)
    return own.unionByName(silent).select(
        *source, F.date_from_unix_date("_debut").alias("debut"), F.date_from_unix_date("_fin").alias("fin"), "nb_valides", "moyenne", "nb_historique"
    )


def check_drift(
    runs: DataFrame,
    today: Column | int,
    mode: str = "daily",
    window: int = HISTORY,
    ratio: float = LOW_RATIO,
    min_history: int = MIN_HISTORY,
) -> DataFrame:
    """One row for the run that just ended: (nb_valides, moyenne, nb_historique, alerte, message).

    Call it before the run is logged.  ``today`` is a number or a scalar subquery.
    """
    last = runs.filter("mode = 'daily'").orderBy(F.desc("horodatage")).limit(window)
    count = today if isinstance(today, Column) else F.lit(today)
    summary = last.agg(F.avg("nb_valides").alias("moyenne"), F.count("*").alias("nb_historique"))
    alert = _verdict(count, F.col("moyenne"), F.col("nb_historique"), min_history, ratio) & F.lit(mode == "daily")
    return summary.select(
        count.cast("bigint").alias("nb_valides"), "moyenne", "nb_historique", alert.alias("alerte")
    ).withColumn(
        "message",
        F.when(F.col("alerte"), drift_message(F.col("nb_valides"), F.col("moyenne"), F.col("nb_historique"))),
    )


def run_row(counts: DataFrame, at: Column | datetime, mode: str) -> DataFrame:
    """A run-log row from a one-row funnel."""
    when = at if isinstance(at, Column) else F.lit(at)
    return counts.select(
        when.alias("horodatage"), F.lit(mode).alias("mode"),
        F.col("nb_bruts").cast("bigint").alias("nb_posts_bruts"),
        F.col("nb_candidats").cast("bigint").alias("nb_candidats"),
        F.col("nb_valides").cast("bigint").alias("nb_valides"),
    )


def run_summary(counts: DataFrame, drift: DataFrame, target: str) -> DataFrame:
    """What a person wants to know about a run, in one row; credentials are masked."""
    return counts.select(
        F.col("nb_bruts").alias("nb_posts_bruts"), "nb_candidats", "nb_valides",
        mask_credentials(F.lit(target)).alias("base_maitre"),
        drift.select("message").scalar().alias("alerte_derive"),
    )

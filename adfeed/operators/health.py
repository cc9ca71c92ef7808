"""Reliability score of a source, folded over its run log.

The score of a run depends on the score before it, so a plain aggregate cannot
compute it, and gathering a source's whole history in one place would not
survive a source with a third of all runs.  But the effect of any stretch of
runs on the state can be written down without knowing the state it starts from:

* the confidence goes through a chain of ``max(lo, a*x + b)`` and
  ``min(hi, a*x + b)`` steps, which collapses into one clamped line;
* the streak of clean runs is 0, 1 or 2, so three cases cover it;
* the multiplier is reset or kept, then doubled some number of times.

The log is range-partitioned by (source, time), every partition reduces its
stretch of each source to one row, and those few rows are chained per source.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeed.functions.checks import anomaly_ratio, false_if_null

# Score settings.
CONFIDENCE_MIN = 0.2
CONFIDENCE_MAX = 1.0
CONFIDENCE_START = 1.0
SUSPICION_FACTOR = 0.5
EXPIRED_FACTOR = 0.7
SUSPICION_RATIO = 0.3
CLEAN_RUNS_TO_RISE = 3
RISE = 0.15
MULTIPLIER_MAX = 8

_INF = float("inf")
_KEEP = (1.0, 0.0, -_INF, _INF)
_STEPS = {
    "blocked": (0.0, CONFIDENCE_MIN, CONFIDENCE_MIN, CONFIDENCE_MIN),
    "expired": (EXPIRED_FACTOR, 0.0, CONFIDENCE_MIN, _INF),
    "suspect": (SUSPICION_FACTOR, 0.0, CONFIDENCE_MIN, _INF),
    "clean": (1.0, RISE, -_INF, CONFIDENCE_MAX),
}


def run_kind(blocked: Column, expired: Column, anomalies: Column, total: Column) -> Column:
    """Outcome of a run as the score sees it; the first that applies decides."""
    return (
        F.when(false_if_null(blocked), "blocked")
        .when(false_if_null(expired), "expired")
        .when(anomaly_ratio(anomalies, total) > SUSPICION_RATIO, "suspect")
        .otherwise("clean")
    )


def _then(first: tuple, second: tuple) -> tuple:
    """The clamped line equal to ``first`` followed by ``second``."""
    a1, b1, lo1, hi1 = first
    a2, b2, lo2, hi2 = second
    if a2 == 0.0:
        return second

    def clamp(x: float) -> float:
        return min(hi2, max(lo2, x))

    return a2 * a1, a2 * b1 + b2, clamp(a2 * lo1 + b2), clamp(a2 * hi1 + b2)


class _Stretch:
    """Effect of consecutive runs, for each streak (0, 1, 2) they may start with."""

    def __init__(self, start):
        self.start, self.last = start, start
        self.cases = [[streak, _KEEP, False, 0] for streak in range(CLEAN_RUNS_TO_RISE)]

    def add(self, kind: str, at) -> None:
        self.last = at
        for case in self.cases:
            if kind == "clean":
                case[0] += 1
                if case[0] < CLEAN_RUNS_TO_RISE:
                    continue
                case[2], case[3] = True, 0
            elif kind == "blocked":
                case[3] += 1
            case[0] = 0
            case[1] = _then(case[1], _STEPS[kind])

    def row(self, source) -> tuple:
        lines = [case[1] for case in self.cases]
        return (
            source, self.start, self.last, [case[0] for case in self.cases],
            *([line[i] for line in lines] for i in range(4)),
            [case[2] for case in self.cases], [case[3] for case in self.cases],
        )


def _reduce_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per source and partition; rows arrive sorted by (source, time)."""
    columns = ["source", "debut", "fin", "serie", "a", "b", "bas", "haut", "remise", "doubles"]
    current, stretch = None, None
    for batch in batches:
        done = []
        for source, at, kind in zip(batch["source"], batch["at"], batch["issue"]):
            if stretch is None or source != current:
                if stretch is not None:
                    done.append(stretch.row(current))
                current, stretch = source, _Stretch(at)
            stretch.add(kind, at)
        yield pd.DataFrame(done, columns=columns)
    if stretch is not None:
        yield pd.DataFrame([stretch.row(current)], columns=columns)


def source_health(
    runs: DataFrame, state: DataFrame | None = None, at: str = "ts", ties: Sequence[str] = ()
) -> DataFrame:
    """Score of every source after its runs, starting from ``state`` where given.

    ``runs`` has source, a time, anomalies, total, bloque, session_expiree.
    Adds the derived settings: ``ratio_groupes`` (the confidence within its
    bounds) and ``delai_multiplicateur`` (its inverse).
    """
    kinds = runs.select(
        F.col("source").cast("string").alias("source"), F.col(at).alias("at"), *ties,
        run_kind(F.col("bloque"), F.col("session_expiree"), F.col("anomalies"), F.col("total")).alias("issue"),
    )
    stretches = (
        kinds.repartitionByRange("source", "at", *ties)
        .sortWithinPartitions("source", "at", *ties)
        .select("source", "at", "issue")
        .mapInPandas(
            _reduce_partition,
            "source STRING, debut TIMESTAMP, fin TIMESTAMP, serie ARRAY<INT>, a ARRAY<DOUBLE>, "
            "b ARRAY<DOUBLE>, bas ARRAY<DOUBLE>, haut ARRAY<DOUBLE>, remise ARRAY<BOOLEAN>, doubles ARRAY<INT>",
        )
    )
    # At most one row per source and range partition, so this list is short.
    chained = stretches.groupBy("source").agg(
        F.array_sort(
            F.collect_list(F.struct("debut", "fin", "serie", "a", "b", "bas", "haut", "remise", "doubles"))
        ).alias("etapes"),
        F.max("fin").alias("derniere_maj"),
    )
    if state is None:
        started = chained.select("*", *[F.lit(None).cast(t).alias(n) for n, t in _STATE_TYPES.items()])
    else:
        started = chained.join(state.select("source", *_STATE_TYPES), "source", "left")
    initial = F.struct(
        F.coalesce("niveau_confiance", F.lit(CONFIDENCE_START)).alias("confiance"),
        F.coalesce("runs_propres_consecutifs", F.lit(0)).alias("serie"),
        F.coalesce("cooldown_multiplicateur", F.lit(1)).alias("multiplicateur"),
    )

    def advance(state_: Column, stretch: Column) -> Column:
        # A stored streak of 3 or more rises on the next clean run, as 2 does.
        case = F.least(state_.serie, F.lit(CLEAN_RUNS_TO_RISE - 1))

        def part(name: str) -> Column:
            return F.get(stretch[name], case)

        line = part("a") * state_.confiance + part("b")
        kept = F.when(part("remise"), F.lit(1)).otherwise(state_.multiplicateur)
        doubled = F.least(F.lit(MULTIPLIER_MAX), kept * F.call_function("shiftleft", F.lit(1), F.least(part("doubles"), F.lit(4))))
        return F.struct(
            F.least(part("haut"), F.greatest(part("bas"), line)).alias("confiance"),
            part("serie").alias("serie"),
            F.when(part("doubles") > 0, doubled).otherwise(kept).alias("multiplicateur"),
        )

    end = F.aggregate("etapes", initial, advance)
    ended = started.select("source", end.alias("_fin"), "derniere_maj")
    share = F.greatest(F.lit(CONFIDENCE_MIN), F.least(F.lit(CONFIDENCE_MAX), F.col("niveau_confiance")))
    return (
        ended.select(
            "source",
            # One rounding step per stretch instead of one per run: cut the noise.
            F.round("_fin.confiance", 12).alias("niveau_confiance"),
            F.col("_fin.serie").alias("runs_propres_consecutifs"),
            F.col("_fin.multiplicateur").alias("cooldown_multiplicateur"),
            "derniere_maj",
        )
        .withColumn("delai_multiplicateur", F.bround(1 / share, 3))
        .withColumn("ratio_groupes", share)
    )


_STATE_TYPES = {
    "niveau_confiance": "double", "runs_propres_consecutifs": "int", "cooldown_multiplicateur": "int",
}

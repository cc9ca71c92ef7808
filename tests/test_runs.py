import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from adfeed.operators.health import source_health
from adfeed.operators.runs import check_drift, densify_days, drift_intervals, run_row, run_summary, volume_drift
from adfeed.schemas import HEALTH, RUNS

START = datetime(2026, 7, 1, 23)


def log(spark, counts, mode="daily"):
    rows = [(START + timedelta(days=i), mode, 100, 50, n) for i, n in enumerate(counts)]
    return spark.createDataFrame(rows, RUNS)


@pytest.mark.parametrize(
    "history, today, mode, alert",
    [
        ([20, 22], 1, "daily", False), ([20, 22, 18, 21, 19], 9, "daily", False), ([20, 22, 18, 21, 19], 0, "daily", True),
        ([20, 22, 18, 21, 19], 0, "backfill", False), ([0, 0, 0], 0, "daily", False), ([10, 10, 10], 3, "daily", False), ([10, 10, 10], 2, "daily", True),
        ([1000] * 3 + [10] * 7, 4, "daily", False), ([], 0, "daily", False),
    ],
)
def test_live_check(spark, history, today, mode, alert):
    row = check_drift(log(spark, history), today, mode).first()
    assert row["alerte"] is alert and (row["message"] is not None) is alert


def test_message_and_other_modes(spark):
    runs = log(spark, [10, 10, 11, 10]).unionByName(log(spark, [9999] * 9, "backfill"))
    row = check_drift(runs, 2).first()
    assert row["message"] == "Low volume: 2 valid ads against 10.2 on average over the last 4 daily runs (20% of the mean)"


def test_history_excludes_the_run_itself(spark):
    runs = log(spark, [10, 10, 10, 2, 10]).withColumn("source", F.lit("s"))
    rows = volume_drift(runs).orderBy("horodatage").collect()
    assert [r["alerte"] for r in rows] == [False, False, False, True, False]
    assert rows[3]["moyenne"] == 10.0 and rows[0]["nb_historique"] == 0


def test_days_without_results_become_rows(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', DATE'2026-01-01', 5L), ('a', DATE'2026-01-04', 5L), ('b', DATE'2026-01-02', 1L) AS t(source, jour, n)")
    dense = densify_days(df, ["source"], "jour", "n").orderBy("source", "jour").collect()
    assert [(r["source"], r["n"]) for r in dense] == [("a", 5), ("a", 0), ("a", 0), ("a", 5), ("b", 1), ("b", 0), ("b", 0)]


def test_a_late_source_has_no_history_before_its_first_day(spark):
    rows = [("ancienne", START + timedelta(days=i), 8) for i in range(20)] + [("neuve", START + timedelta(days=i), 10 if i < 19 else 1) for i in (16, 17, 18, 19)]
    rows += [("egaree", START - timedelta(days=4000), 1)]
    counts = spark.createDataFrame(rows, "source STRING, at TIMESTAMP, n BIGINT").select("source", F.to_date("at").alias("horodatage"), F.col("n").alias("nb_valides"))
    found = volume_drift(densify_days(counts, ["source"], "horodatage", "nb_valides")).filter("source = 'neuve'").orderBy("horodatage").collect()
    assert [(r["nb_historique"], r["moyenne"], r["alerte"]) for r in found] == [(0, None, False), (1, 10.0, False), (2, 10.0, False), (3, 10.0, True)]


def test_run_row_and_summary(spark):
    counts = spark.sql("SELECT 10L nb_bruts, 4L nb_candidats, 3L nb_valides")
    row = run_row(counts, START, "daily").first()
    assert tuple(row) == (START, "daily", 10, 4, 3)
    summary = run_summary(counts, check_drift(log(spark, [90, 90, 90]), 3), "postgresql://u:secret@h/b").first()
    assert summary["base_maitre"] == "postgresql://u:***@h/b" and summary["alerte_derive"].startswith("Low volume: 3")


def frame(spark, histories):
    rows = [
        (source, START + timedelta(hours=i), a, t, b, e)
        for source, runs in histories.items() for i, (a, t, b, e) in enumerate(runs)
    ]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "source STRING, ts TIMESTAMP, anomalies BIGINT, total BIGINT, bloque BOOLEAN, session_expiree BOOLEAN")


CLEAN, SUSPECT, BLOCKED, EXPIRED = (0, 5, False, False), (4, 5, False, False), (0, 5, True, False), (0, 5, False, True)


def scores(spark, histories, state=None):
    """source -> (score, clean runs in a row, pause factor), the score to nine digits."""
    rows = source_health(frame(spark, histories), state) if state is not None else source_health(frame(spark, histories))
    return {r["source"]: (round(r["niveau_confiance"], 9), r["runs_propres_consecutifs"], r["cooldown_multiplicateur"]) for r in rows.collect()}


def test_score_cases(spark):
    """Histories from the start (1.0, 0, 1), with results worked out by hand."""
    cases = {
        "bloque": ([BLOCKED], (0.2, 0, 2)),
        "plafond": ([BLOCKED] * 5, (0.2, 0, 8)),
        "expire": ([EXPIRED], (0.7, 0, 1)),
        "expire_2": ([EXPIRED] * 2, (0.49, 0, 1)),
        "suspect": ([SUSPECT], (0.5, 0, 1)),
        "plancher": ([SUSPECT] * 4, (0.2, 0, 1)),
        "limite": ([(3, 10, False, False)], (1.0, 1, 1)),
        "montee": ([SUSPECT, CLEAN, CLEAN, CLEAN], (0.65, 0, 1)),
        "interrompu": ([SUSPECT, CLEAN, CLEAN, EXPIRED, CLEAN], (0.35, 1, 1)),
        "maximum": ([CLEAN] * 3, (1.0, 0, 1)),
        "zero": ([(0, 0, False, False)], (1.0, 1, 1)),
        "remise": ([BLOCKED] + [CLEAN] * 3 + [BLOCKED], (0.2, 0, 2)),
        "long": ([BLOCKED] * 2 + [CLEAN] * 7, (0.5, 1, 1)),
        "nul": ([(0, 5, None, None)], (1.0, 1, 1)),
    }
    assert scores(spark, {s: runs for s, (runs, _) in cases.items()}) == {s: want for s, (_, want) in cases.items()}
    rows = {r["source"]: r for r in source_health(frame(spark, {"suspect": [SUSPECT]})).collect()}
    assert (rows["suspect"]["delai_multiplicateur"], rows["suspect"]["ratio_groupes"]) == (2.0, 0.5)


def test_score_goes_on_from_the_stored_state(spark):
    stored = {"a": (0.5, 2, 4), "b": (0.0, 1, 16), "c": (5.0, 0, 1), "d": (0.35, 0, 2)}
    state = spark.createDataFrame([(s, c, k, m, START) for s, (c, k, m) in stored.items()], HEALTH)
    histories = {"a": [CLEAN], "b": [CLEAN], "c": [EXPIRED], "d": [CLEAN] * 7 + [BLOCKED, CLEAN], "e": [SUSPECT]}
    want = {"a": (0.65, 0, 1), "b": (0.0, 2, 16), "c": (3.5, 0, 1), "d": (0.2, 1, 2), "e": (0.5, 0, 1)}
    assert scores(spark, histories, state) == want


def test_one_fold_equals_two_and_a_hot_source_its_copy(spark):
    """Carrying the state over a cut changes nothing, nor does a source's share of the log."""
    draw = random.Random(5)
    kinds = [CLEAN] * 6 + [SUSPECT, BLOCKED, EXPIRED]
    histories = {f"s{i}": [draw.choice(kinds) for _ in range(draw.randint(2, 60))] for i in range(60)}
    histories["chaude"] = [draw.choice(kinds) for _ in range(3000)]
    whole = scores(spark, histories)
    first = {s: runs[: len(runs) // 2] for s, runs in histories.items()}
    second = {s: runs[len(runs) // 2 :] for s, runs in histories.items()}
    before = scores(spark, first)
    state = spark.createDataFrame([(s, *v, START) for s, v in before.items()], HEALTH)
    after = scores(spark, second, state)
    assert after.keys() == whole.keys()
    for source, (score, streak, factor) in whole.items():
        assert after[source] == (pytest.approx(score, abs=1e-8), streak, factor), source
    assert all(0.2 <= score <= 1.0 and 0 <= streak < 3 and 1 <= factor <= 8 for score, streak, factor in whole.values())
    assert scores(spark, {"seule": histories["chaude"]})["seule"] == whole["chaude"]


def test_intervals_are_the_alerts_of_dense_days(spark):
    draw = random.Random(7)
    rows = [(s, date(2026, 1, 1) + timedelta(days=d), draw.choice([0, 0, 1, 9, 30])) for s in "abcdef" for d in sorted(draw.sample(range(60), draw.choice([1, 3, 12, 30])))]
    counts = spark.createDataFrame(rows, "source STRING, horodatage DATE, nb_valides BIGINT")
    dense = volume_drift(densify_days(counts, ["source"], "horodatage", "nb_valides")).filter("alerte").collect()
    want = sorted((r["source"], r["horodatage"], r["nb_valides"]) for r in dense)
    found = drift_intervals(counts).collect()
    days = sorted((r["source"], r["debut"] + timedelta(days=i), r["nb_valides"]) for r in found for i in range((r["fin"] - r["debut"]).days + 1))
    assert days == want and len(found) < len(want)
    means = {(r["source"], r["horodatage"]): (r["moyenne"], r["nb_historique"]) for r in dense}
    assert all((r["moyenne"], r["nb_historique"]) == means[r["source"], r["debut"]] for r in found if r["moyenne"] is not None)


def test_a_date_far_off_adds_no_rows(spark):
    rows = [("a", START + timedelta(days=i), 10) for i in range(5)] + [("b", datetime(2999, 1, 1), 4), ("c", datetime(1, 1, 1), 4)]
    counts = spark.createDataFrame(rows, "source STRING, horodatage TIMESTAMP, nb_valides BIGINT")
    found = drift_intervals(counts).collect()
    last = (START + timedelta(days=4)).date()
    assert sorted((r["source"], r["debut"], r["fin"]) for r in found) == [("a", last + timedelta(days=1), last + timedelta(days=7)), ("c", date(1, 1, 4), date(1, 1, 8))]
    assert "Generate" not in drift_intervals(counts)._jdf.queryExecution().optimizedPlan().toString()

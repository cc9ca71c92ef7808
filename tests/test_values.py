from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from adfeed.functions.capture import capture_status
from adfeed.functions.checks import anomaly_ratio, false_if_null, non_negative, unknown_value
from adfeed.functions.dates import epoch_ts, parse_relative_ts, window_cutoff
from adfeed.functions.vocab import DOCUMENT_STATUSES, ZONES, canonicalise, canonicalise_join

NOW = datetime(2026, 8, 1, 15, 0)


def test_zones(evaluate):
    values = ["Karpala", "ouaga 2000", "Ailleurs", None, "", "  ", " RIMKIÉTA\u00a0", "patte d'oie"]
    expected = ["Karpala", "Ouaga 2000", "Ailleurs", None, None, "", "Rimkiéta", "Patte d'Oie"]
    assert evaluate(lambda c: canonicalise(c, ZONES), values) == expected


def test_statuses_stay_apart(evaluate):
    values = ["ATTESTATION", "attestation d'attribution", "Attestation villageoise", None, "", "puh"]
    expected = ["Attestation", "Attestation d'attribution", "Attestation villageoise", None, None, "PUH"]
    assert evaluate(lambda c: canonicalise(c, DOCUMENT_STATUSES), values) == expected


def test_vocabulary_table_gives_the_same(spark):
    values = [(i, v) for i, v in enumerate(["karpala", " Pissy ", "x ", None, "", " "])]
    df = spark.createDataFrame(values, "i INT, zone STRING")
    vocab = spark.createDataFrame([(z,) for z in ZONES + ["KARPALA"][:0]], "valeur STRING")
    joined = {r["i"]: r["zone"] for r in canonicalise_join(df, "zone", vocab).collect()}
    mapped = {r["i"]: r["z"] for r in df.select("i", canonicalise(F.col("zone"), ZONES).alias("z")).collect()}
    assert joined == mapped and mapped[1] == "Pissy"


def test_checks(spark):
    df = spark.sql("SELECT * FROM VALUES (-5L, 'villa', 4, 5), (0L, 'château', 0, 0), (NULL, NULL, 1, 4) AS t(n, k, a, t)")
    rows = df.select(
        non_negative(F.col("n")), unknown_value(F.col("k")), anomaly_ratio(F.col("a"), F.col("t")), false_if_null(F.col("n") > 0)
    ).collect()
    assert [tuple(r) for r in rows] == [(None, False, 0.8, False), (0, True, 0.0, False), (None, True, 0.25, False)]


DATES = [
    ("12 min", NOW - timedelta(minutes=12)), ("3 h", NOW - timedelta(hours=3)), ("3 H", NOW - timedelta(hours=3)),
    ("5 j", NOW - timedelta(days=5)), ("5j", NOW - timedelta(days=5)), ("à l'instant", NOW), (" Just now ", NOW),
    ("Hier", datetime(2026, 7, 31)), ("Hier à 14:30", datetime(2026, 7, 31, 14, 30)), ("hier a 7h05", datetime(2026, 7, 31, 7, 5)),
    ("Aujourd'hui à 09:15", datetime(2026, 8, 1, 9, 15)), ("aujourdhui", datetime(2026, 8, 1)),
    ("1 août", datetime(2026, 8, 1, 12)), ("2 août", datetime(2025, 8, 2, 12)), ("3 mars 2024", datetime(2024, 3, 3, 12)),
    ("3 mars 2024 à 18:45", datetime(2024, 3, 3, 18, 45)), ("31 décembre", datetime(2025, 12, 31, 12)),
    ("31 février", None), ("mardi prochain", None), ("", None), (None, None), ("hier à 25:00", None), ("29 février", None),
    ("1 août 2026 à 12:60", None), ("999999999999999999 j", None), ("99999999999 h", None), ("1 mars 0000", None), ("12 minutes", None),
]


def test_relative_dates(evaluate):
    got = evaluate(lambda c: parse_relative_ts(c, NOW), [t for t, _ in DATES])
    assert got == [e for _, e in DATES]


def test_leap_day_rolled_back_a_year_is_no_date(evaluate):
    got = evaluate(lambda c: parse_relative_ts(c, datetime(2024, 1, 15, 10)), ["29 février", "28 février", "29 février 2024"])
    assert got == [None, datetime(2023, 2, 28, 12), datetime(2024, 2, 29, 12)]


def test_epoch_seconds(evaluate):
    values = [1.7e9, 1700000000.123456, 1e9, 5.0, None, 1e20, float("inf"), float("nan")]
    got = evaluate(epoch_ts, values, "double")
    assert got == [datetime(2023, 11, 14, 22, 13, 20), datetime(2023, 11, 14, 22, 13, 20, 123456), None, None, None, None, None, None]


def test_window_cutoff(spark):
    row = spark.range(1).select(window_cutoff(NOW), window_cutoff(NOW, "backfill"), window_cutoff(NOW, days_back=2)).first()
    assert list(row) == [NOW - timedelta(days=d) for d in (1, 7, 2)]
    with pytest.raises(ValueError):
        window_cutoff(NOW, days_back=0)


PAGES = [
    ("https://x/groups/1", "<html>normal</html>", "ok"),
    ("https://x/Checkpoint/1", "<html></html>", "blocked"),
    ("https://x/groups/1", "<p>Nous voulons juste VÉRIFIER que c'est vous", "blocked"),
    ("https://x/groups/1", '{"USER_ID":"0"}', "session_expired"),
    ("https://x/groups/1", '{"actorID":"0"}', "session_expired"),
    ("https://x/groups/1", '{"USER_ID":"61"}', "ok"),
    ("https://x/groups/1", '<form id="login_form">', "session_expired"),
    ("https://x/groups/1", "<input type='x' name='pass'>", "session_expired"),
    ("https://x/groups/1", '<input name="passage"> id="login_form"', "ok"),
    ("https://x/groups/1", None, "ok"),
]


def test_capture_status(spark):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(PAGES)], "i INT, url STRING, html STRING, attendu STRING")
    rows = df.select("i", "attendu", capture_status(F.col("url"), F.col("html")).alias("s")).orderBy("i").collect()
    assert [r["s"] for r in rows] == [r["attendu"] for r in rows]

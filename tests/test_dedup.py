from pyspark.sql import functions as F

from adfeed.operators.dedup import dedup_first, dedup_last, dedup_text, text_duplicates


def test_text_copies(spark):
    rows = [(0, "a", "x"), (1, "b", "y"), (2, "c", "x"), (3, "d", ""), (4, "e", ""), (5, "f", None)]
    df = spark.createDataFrame(rows, "pos INT, id STRING, texte_nettoye STRING")
    assert sorted(r["id"] for r in dedup_text(df, ["pos"]).collect()) == ["a", "b", "d", "e", "f"]
    assert [tuple(r) for r in text_duplicates(df, ["pos"]).collect()] == [("c", "a")]


def test_last_value_first_position(spark):
    rows = [("a", 0, "1"), ("b", 1, "2"), ("a", 2, "3")]
    df = spark.createDataFrame(rows, "id STRING, pos INT, v STRING")
    got = dedup_last(df, "id", ["pos"]).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [("a", 0, "3"), ("b", 1, "2")]


def test_a_null_value_can_be_the_last(spark):
    df = spark.createDataFrame([("a", 0, "1"), ("a", 1, None)], "id STRING, pos INT, v STRING")
    assert [tuple(r) for r in dedup_last(df, "id", ["pos"]).collect()] == [("a", 0, None)]


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(0, 60_000, numPartitions=8).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("même texte")).otherwise(F.col("id").cast("string")).alias("texte_nettoye")
    )
    kept = dedup_text(df, ["id"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan
    assert kept.count() == 40_001
    assert text_duplicates(df, ["id"]).agg(F.count("*"), F.max("id_garde")).first()[:] == (19_999, 0)


def test_first_per_page(spark):
    df = spark.createDataFrame([("p", "a", 1, 0), ("p", "a", 0, 3), ("q", "a", 2, 2)], "page STRING, id STRING, b INT, r INT")
    assert {tuple(r) for r in dedup_first(df, ["page", "id"], ["b", "r"]).collect()} == {("p", "a", 0, 3), ("q", "a", 2, 2)}

"""Patterns of a whole run are searched once per text, and only in texts that may hold a match."""

import random

from pyspark.sql import functions as F

from adfeed.functions import extract
from adfeed.functions.rules import folded
from adfeed.sinks import exports


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def noise(letters, n=3000):
    draw = random.Random(7)
    return ["".join(draw.choices(letters, k=draw.randint(0, 24))) for _ in range(n)]


def test_amounts_are_searched_once(spark):
    texts = spark.createDataFrame([("500 m2",)], "t STRING")
    for amount in (extract.area_m2, extract.price):
        assert plan(texts.select(amount(F.col("t")).alias("r"))).count("regexp_extract_all") == 1


def test_vocabulary_is_not_searched_without_a_stem(spark):
    """The stem test stands before the search, and lets odd cases pass."""
    texts = spark.createDataFrame([("a \u212aARPALA",), ("k",), (None,), ("Karpala, Pissy",)], "t STRING")
    named = texts.select(extract.first_named(F.col("t"), ["Pissy", "Karpala"]).alias("z"))
    assert "karpala" in plan(named)
    assert [r["z"] for r in named.collect()] == ["Karpala", None, None, "Karpala"]


def test_odd_letters_are_looked_for_before_they_are_replaced(spark):
    texts = spark.createDataFrame([("\u017f\u0130X",), ("ABC",), (None,)], "t STRING")
    fold = texts.select(folded(F.col("t")).alias("f"))
    assert "contains" in plan(fold).lower()
    assert [r["f"] for r in fold.collect()] == ["six", "abc", None]


def test_master_export_masks_after_the_sort(spark, folder, monkeypatch):
    """Sorting samples its input first, which would mask every text twice."""
    written = []
    monkeypatch.setattr(exports, "write_csv", lambda df, *rest: written.append(df))
    path = f"{folder}/m"
    spark.createDataFrame([("1", "tel 70 11 22 33")], "id STRING, texte_nettoye STRING").withColumn("derniere_maj", F.current_timestamp()).write.parquet(path)
    exports.export_master(spark.read.parquet(path), "nowhere")
    text = plan(written[0])
    assert "regexp_replace" in text.split("Sort [")[0] and "regexp_replace" not in text.split("Sort [")[1]
    assert written[0].first()["texte_nettoye"] == "tel **33"


def test_phone_patterns_match_as_before(spark):
    amount = r"[0-9]{1,3}(?:[ .\u00a0][0-9]{3})+(?![ .\-()\u00a0]?[0-9])"
    gap = r"[ ().\-\u00a0]{0,2}"
    mask = rf"(?i)(?<![0-9])(?!{amount})\+?[0-9](?:{gap}[0-9]){{5,12}}{gap}([0-9]){gap}([0-9])(?![0-9])(?!\s*(?:f\s*)?cfa)"
    phone = r"(?i)\+?[0-9][0-9 ()-]*[0-9](\s*f?\s*cfa)?"
    price = r"(?i)([0-9]{1,3}(?:[\s.][0-9]{3})+|[0-9]+)\s*(f?\s*cfa)([\p{L}\p{N}_]?)"
    texts = noise("0123456789" * 3 + "++  .-()\u00a0xcfaCFA\n") + [f"{a} cfa{b}" for a, b in zip(noise("0123 .+", 500), noise("xF 1", 500))]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING")

    def found(pattern):
        return F.regexp_extract_all("t", F.lit(pattern), F.lit(0))

    differ = (
        ~F.regexp_replace("t", mask, "<$1$2>").eqNullSafe(F.regexp_replace("t", exports.PHONE, "<$1$2>"))
        | ~found(phone).eqNullSafe(found(extract.PHONE)) | ~found(price).eqNullSafe(found(extract.PRICE))
    )
    assert [r["t"] for r in rows.filter(differ).collect()] == []
    assert rows.filter(F.size(found(extract.PHONE)) > 0).count() > 1000 and rows.filter(F.col("t").rlike(exports.PHONE)).count() > 100

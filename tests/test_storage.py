import csv
import glob
import json
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from adfeed.operators.seen import unseen
from adfeed.operators.upsert import latest_first, merge_batch, merge_lots
from adfeed.schemas import AD_COLUMNS, MARKERS, MASTER, SEEN
from adfeed.sinks.exports import export_ads, export_candidates, export_master, protect_contacts, write_rejects
from adfeed.sinks.tables import append_raw, log_run, save_markers, save_seen, upsert_master
from adfeed.sources import journal
from adfeed.sources.groups import load_groups
from adfeed.sources.posts import file_issues, line_issues, load_raw_post_lines, load_raw_posts, load_raw_table
from adfeed.sources.state import load_markers, load_master, load_runs, load_seen
from adfeed.sources.tables import read_table, versions, write_table

DAY1, DAY2 = datetime(2026, 8, 1), datetime(2026, 8, 2, 3, 4, 5, 600)


def ads(spark, *rows):
    """(id, price) rows with the other business columns filled alike."""
    df = spark.createDataFrame([(i, n, p) for n, (i, p) in enumerate(rows)], "id STRING, _pos INT, prix_fcfa BIGINT")
    return df.select(
        "id", "_pos", "prix_fcfa", F.lit('Le "groupe", un').alias("groupe_nom"), F.lit(True).alias("date_incertaine"),
        F.array(F.lit("70 12 34 56"), F.lit("x")).alias("contacts_whatsapp"), F.array().cast("array<string>").alias("mots_cles_pertinents"),
        F.lit(" ligne\nsuivante ").alias("resume_court"),
    )


def prices(df):
    return {r["id"]: (r["prix_fcfa"], r["premiere_collecte"], r["derniere_maj"]) for r in df.collect()}


def test_upsert_keeps_the_first_date(spark, folder):
    assert upsert_master(ads(spark, ("a", 1), ("b", 2)), folder, DAY1, ["_pos"]) == 0
    assert upsert_master(ads(spark, ("a", 9), ("c", 3_000_000_000)), folder, DAY2, ["_pos"]) == 1
    assert prices(load_master(spark, folder)) == {"a": (9, DAY1, DAY2), "b": (2, DAY1, DAY1), "c": (3_000_000_000, DAY2, DAY2)}
    assert prices(load_master(spark, folder, 0)) == {"a": (1, DAY1, DAY1), "b": (2, DAY1, DAY1)}


def test_upsert_twice_is_once(spark, folder):
    batch = ads(spark, ("a", 1), ("b", 2))
    upsert_master(batch, folder, DAY1, ["_pos"])
    upsert_master(batch, folder, DAY2, ["_pos"])
    assert prices(load_master(spark, folder)) == {"a": (1, DAY1, DAY2), "b": (2, DAY1, DAY2)}


def test_empty_batch_and_repeats_in_a_batch(spark, folder):
    assert upsert_master(ads(spark, ("a", 1)).filter("false"), folder, DAY1, ["_pos"]) is None and journal.versions(spark, folder) == []
    upsert_master(ads(spark, ("a", 1), ("b", 2), ("a", 3), (None, 4)), folder, DAY1, ["_pos"])
    assert prices(load_master(spark, folder)) == {"a": (3, DAY1, DAY1), "b": (2, DAY1, DAY1)}


def test_a_batch_of_a_query_counts_once(spark, folder):
    assert upsert_master(ads(spark, ("a", 1)), folder, DAY1, ["_pos"], ("q", 0)) == 0
    assert upsert_master(ads(spark, ("b", 1)), folder, DAY2, ["_pos"], ("q", 1)) == 1
    assert upsert_master(ads(spark, ("b", 5)), folder, DAY2, ["_pos"], ("q", 1)) is None
    assert upsert_master(ads(spark, ("b", 7)), folder, DAY2, ["_pos"], ("autre", 0)) == 2
    assert prices(load_master(spark, folder, 1))["b"] == (1, DAY2, DAY2) and prices(load_master(spark, folder))["b"] == (7, DAY2, DAY2)


def test_a_batch_leaves_earlier_lots_alone_and_old_ones_go(spark, folder):
    upsert_master(ads(spark, *[(f"p{i}", i) for i in range(300)]), folder, DAY1, ["_pos"])
    first = journal.state(spark, folder).lots[0]
    for n in range(1, 20):
        upsert_master(ads(spark, ("p7", 1000 + n), (f"q{n}", n)), folder, DAY2, ["_pos"])
    now = journal.state(spark, folder)
    assert now.lots[0] == first and first.rows == 300 and len(now.lots) < 10
    assert len(glob.glob(f"{folder}/lots/*")) < 20 and len(glob.glob(f"{folder}/journal/*")) == journal.KEPT
    stored = prices(load_master(spark, folder))
    assert len(stored) == 319 and stored["p7"] == (1019, DAY1, DAY2) and stored["p8"] == (8, DAY1, DAY1) and stored["q3"] == (3, DAY2, DAY2)
    assert prices(load_master(spark, folder, now.version - 1))["p7"][0] in (1018, 1019)
    assert journal.compact(spark, folder, MASTER, merge_lots, everything=True) == now.version + 1
    assert prices(load_master(spark, folder)) == stored and len(journal.state(spark, folder).lots) == 1


def test_seen_days_beyond_the_retention_go(spark, folder):
    def seen(*rows):
        return spark.createDataFrame(rows, "id STRING, scrape_le STRING")

    save_seen(seen(("vieux", "2026-03-01T00:00:00+00:00"), ("illisible", "hier"), ("neuf", "2026-08-01T00:00:00+00:00")), folder, datetime(2026, 3, 2))
    assert load_seen(spark, folder).count() == 3
    save_seen(seen(("neuf", "2026-08-02T00:00:00+00:00")), folder, DAY2)
    assert {tuple(r) for r in load_seen(spark, folder).collect()} == {("illisible", "hier"), ("neuf", "2026-08-01T00:00:00+00:00")}


def test_only_days_that_may_hold_an_id_are_read(spark, folder):
    def seen(day, *ids):
        return spark.createDataFrame([(i, f"2026-07-{day:02d}T10:00:00+00:00") for i in ids], "id STRING, scrape_le STRING")

    for day in range(1, 8):
        save_seen(seen(day, *[f"{day}-{i}" for i in range(50)], "commun"), folder, DAY1)
    whole = {tuple(r) for r in load_seen(spark, folder).collect()}
    assert len(whole) == 351 and ("commun", "2026-07-01T10:00:00+00:00") in whole
    asked = spark.createDataFrame([("3-7",), ("3-9",), ("5-0",), ("neuf",), ("commun",)], "id STRING")
    some = load_seen(spark, folder, asked)
    assert {f.split("jour=")[1][:10] for f in some.inputFiles()} == {"2026-07-01", "2026-07-03", "2026-07-05"}
    assert [r["id"] for r in unseen(asked, some).collect()] == ["neuf"]
    assert load_seen(spark, folder, asked.filter("id = 'neuf'")).count() == 0
    shutil.rmtree(f"{folder}/_esquisses/jour=2026-07-02")  # as written before there were sketches
    assert {f.split("jour=")[1][:10] for f in load_seen(spark, folder, asked.filter("id = 'neuf'")).inputFiles()} == {"2026-07-02"}


def test_a_small_batch_does_not_shuffle_the_master(spark, folder):
    upsert_master(ads(spark, ("a", 1), ("b", 2)), folder, DAY1, ["_pos"])
    master = load_master(spark, folder)
    write_table(ads(spark, ("a", 7)).select("id", "prix_fcfa"), f"{folder}/lot")
    batch = spark.read.parquet(f"{folder}/lot/v=0")
    full = batch.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in MASTER if f.name not in batch.columns])
    plan = merge_batch(master, full, DAY2)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_unfinished_snapshots_do_not_count(spark, folder):
    write_table(spark.createDataFrame([("g", "1")], MARKERS), folder)
    spark.createDataFrame([("g", "2")], MARKERS).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}/v=1")
    assert versions(spark, folder) == [0] and load_markers(spark, folder).first()["post_id"] == "1"
    assert read_table(spark, f"{folder}/absent", MARKERS).count() == 0


def test_state_tables(spark, folder):
    posts = spark.createDataFrame([("p", "2026-08-01T00:00:00+00:00")], "id STRING, scrape_le STRING")
    assert load_seen(spark, f"{folder}/vus").schema == SEEN
    save_seen(posts, f"{folder}/vus", DAY1)
    save_seen(posts, f"{folder}/vus", DAY2)
    assert load_seen(spark, f"{folder}/vus").count() == 1
    save_markers(spark.createDataFrame([("g", "1")], MARKERS), f"{folder}/reperes")
    save_markers(spark.createDataFrame([("g", ""), ("h", "2")], MARKERS), f"{folder}/reperes")
    assert {tuple(r) for r in load_markers(spark, f"{folder}/reperes").collect()} == {("g", "1"), ("h", "2")}
    assert load_runs(spark, f"{folder}/runs").count() == 0
    row = spark.sql("SELECT TIMESTAMP'2026-08-01 00:00:00' horodatage, 'daily' mode, 1L nb_posts_bruts, 1L nb_candidats, 0L nb_valides")
    log_run(row, f"{folder}/runs")
    log_run(row, f"{folder}/runs")
    assert load_runs(spark, f"{folder}/runs").count() == 2


def read_export(path):
    rows, raw = [], b""
    for part in sorted(glob.glob(f"{path}/part-*.csv")):
        with open(part, "rb") as f:
            raw += f.read()
        with open(part, encoding="utf-8-sig", newline="") as f:
            rows += list(csv.DictReader(f))
    return rows, raw


def test_csv_is_what_the_csv_module_reads(spark, folder):
    export_ads(ads(spark, ("a", None)), folder, contacts="raw")
    rows, raw = read_export(folder)
    assert raw.startswith(b"\xef\xbb\xbfid,") and b"\r\n" in raw
    assert list(rows[0]) == AD_COLUMNS
    assert rows[0] == {
        **dict.fromkeys(AD_COLUMNS, ""), "id": "a", "groupe_nom": 'Le "groupe", un', "date_incertaine": "True",
        "contacts_whatsapp": "70 12 34 56; x", "resume_court": " ligne\r\nsuivante ",
    }
    assert b'a,"Le ""groupe"", un",,,True,,' in raw


def test_csv_without_rows_has_a_header(spark, folder):
    export_candidates(ads(spark, ("a", 1)).filter("false"), folder, bom=False)
    assert read_export(folder)[1] == b"id,groupe_nom,url,texte_nettoye\r\n"


def test_contacts_are_masked_unless_asked_for(spark):
    df = ads(spark, ("a", 1))
    assert protect_contacts(df).first()["contacts_whatsapp"] == ["** ** ** 56", "x"]
    assert len(protect_contacts(df, "hash").first()["contacts_whatsapp"][0]) == 64
    assert protect_contacts(df, "raw").first()["contacts_whatsapp"] == ["70 12 34 56", "x"]
    texts = ["tel 70 12 34 56.", "+226 76-54-32-10 ou 70123456", "15 000 000 FCFA, 9.500.000 et 12345678 f cfa", "lot 1234567, 600 m2"]
    cells = spark.createDataFrame([(t,) for t in texts], "texte STRING")
    assert [r["texte"] for r in protect_contacts(cells).collect()] == ["tel **56.", "**10 ou **56", texts[2], texts[3]]
    with pytest.raises(ValueError):
        protect_contacts(df, "clair")


def test_consultation_copy_is_ordered(spark, folder):
    upsert_master(ads(spark, ("a", 1), ("b", 2)), f"{folder}/m", DAY1, ["_pos"])
    upsert_master(ads(spark, ("b", 3)), f"{folder}/m", DAY2, ["_pos"])
    for _ in range(2):
        export_master(load_master(spark, f"{folder}/m"), f"{folder}/vue")
    rows, _ = read_export(f"{folder}/vue")
    assert [(r["id"], r["derniere_maj"]) for r in rows] == [("b", "2026-08-02T03:04:05.000600+00:00"), ("a", "2026-08-01T00:00:00+00:00")]
    assert [r["id"] for r in latest_first(load_master(spark, f"{folder}/m")).collect()] == ["b", "a"]


def test_rejects_keep_null_fields_and_accents(spark, folder):
    one = spark.createDataFrame([("a", None, "texte_vide")], "id STRING, texte STRING, motif_rejet STRING")
    two = spark.createDataFrame([("b", "llm_juge_invalide", "évident")], "id STRING, motif_rejet STRING, type_bien STRING")
    write_rejects(one, two, folder)
    lines = [json.loads(line) for f in glob.glob(f"{folder}/motif_rejet=*/part-*.json") for line in open(f, encoding="utf-8")]
    assert sorted(lines, key=lambda r: r["id"]) == [{"id": "a", "texte": None, "type_bien": None}, {"id": "b", "texte": None, "type_bien": "évident"}]


GROUPS = 'id,nom,url,actif,membres\n1,"Groupe, un",https://x/1,true,5\n 2 ,Deux, https://x/2 ,OUI,5\n3,Trois,u,false,5\ntodo_9,Non,u,true,5\n'


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_groups(spark, folder):
    path = write(f"{folder}/g.csv", GROUPS)
    assert [tuple(r) for r in load_groups(spark, path).collect()] == [("1", "Groupe, un", "https://x/1", True), ("2", "Deux", "https://x/2", True)]
    assert [r["id"] for r in load_groups(spark, path, 1).collect()] == ["1"]
    assert load_groups(spark, path, 0).count() == 2
    with pytest.raises(FileNotFoundError):
        load_groups(spark, f"{folder}/absent.csv")
    with pytest.raises(ValueError):
        load_groups(spark, write(f"{folder}/h.csv", "a,b\n1,2\n"))
    with pytest.raises(ValueError):
        load_groups(spark, write(f"{folder}/v.csv", "id,nom,url,actif\nTODO_1,x,u,true\n"))


def test_raw_files(spark, folder):
    write(f"{folder}/1.json", json.dumps([{"id": "a", "texte": "un"}, {"id": "b", "texte": "deux", "date_incertaine": True, "autre": 1}]))
    write(f"{folder}/2.json", json.dumps([{"texte": "sans id"}, {"id": "a", "texte": "un bis"}], indent=2))
    write(f"{folder}/3.json", '[{"id": "c", "texte": "coup')
    write(f"{folder}/4.json", '{"id": "d", "texte": "objet"}')
    write(f"{folder}/5.json", " \n")
    write(f"{folder}/6.json", '[{"id": "e", "id": "f", "texte": "clé double"}]\n')
    write(f"{folder}/7.json", '[{"id": "g", "texte": "x"}, {"id": ]')
    write(f"{folder}/8.json", "[]")
    posts = load_raw_posts(spark, f"{folder}/*.json").orderBy("_file", "_pos").collect()
    assert [(r["id"], r["texte"]) for r in posts] == [("a", "un bis"), ("b", "deux"), ("f", "clé double")] and posts[1]["date_incertaine"] is True
    files = spark.read.text(f"{folder}/*.json", wholetext=True).select(F.col("_metadata.file_name").alias("_file"), "value")
    assert {tuple(r) for r in file_issues(files).collect()} == {("2.json", True, 1), ("3.json", False, 0), ("4.json", False, 0), ("5.json", False, 0), ("7.json", False, 0)}


def test_line_files_and_appended_tables(spark, folder):
    write(f"{folder}/1.jsonl", '{"id":"a","texte":"un"}\n{"id":"b","texte":"x"}\nnon\n')
    write(f"{folder}/2.jsonl", '{"id":"a","texte":"deux"}\n')
    assert {(r["id"], r["texte"]) for r in load_raw_post_lines(spark, f"{folder}/*.jsonl").collect()} == {("a", "deux"), ("b", "x")}
    assert [(r["value"], r["lisible"]) for r in line_issues(spark, f"{folder}/*.jsonl").collect()] == [("non", False)]
    write(f"{folder}/3.txt", '{"id":"z","texte":"b","_pos":2}\n{"id":"z","texte":"a","_pos":1}\n{"texte":"sans id"}\n[1]\n\n')
    assert [r["texte"] for r in load_raw_post_lines(spark, f"{folder}/3.txt").collect()] == ["b"]
    assert {(r["value"], r["lisible"]) for r in line_issues(spark, f"{folder}/3.txt").collect()} == {('{"texte":"sans id"}', True), ("[1]", False)}
    posts = load_raw_post_lines(spark, f"{folder}/1.jsonl").withColumn("groupe_id", F.lit("g")).withColumn("_pos", F.array("_pos")).drop("_file", "_bloc")
    append_raw(posts.filter("false"), f"{folder}/t", "20260731T000000Z")
    append_raw(posts, f"{folder}/t", "20260801T000000Z")
    append_raw(posts.filter("id = 'a'").withColumn("texte", F.lit("corrigé")).withColumn("groupe_id", F.lit("h")), f"{folder}/t", "20260802T000000Z")
    stored = {r["id"]: (r["texte"], r["groupe_id"]) for r in load_raw_table(spark, f"{folder}/t").collect()}
    assert stored == {"a": ("corrigé", "h"), "b": ("x", "g")}

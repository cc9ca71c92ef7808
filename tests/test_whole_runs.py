import glob
import json
import os
import sys
from datetime import datetime, timedelta

import pytest
from pyspark import cloudpickle

from adfeed.operators.health import source_health
from adfeed.operators.structure import structure_once
from adfeed.plans.runs import Places, collect_posts, full_run, rules_only_run
from adfeed.sinks.tables import save_health
from adfeed.sources.posts import ORDER, file_issues, load_raw_posts, load_raw_table
from adfeed.sources.state import load_health, load_markers, load_master, load_runs, load_seen
from adfeed.sources import journal
from adfeed.streaming import ingest
from adfeed.streaming.ingest import first_post_stream, read_new_files, score_stream, upsert_stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NOW = datetime(2026, 8, 1, 23)
SALE = "Vends parcelle 500 m2 à Karpala, PUH, 9 000 000 FCFA, tel 70 11 22 33"
POSTS = [
    {"id": "1", "groupe_nom": "G", "texte": SALE}, {"id": "2", "groupe_nom": "G", "texte": "Je recherche un terrain"},
    {"id": "3", "groupe_nom": "H", "texte": "Forex trading facile, terrain"}, {"id": "4", "groupe_nom": "H", "texte": "Bonjour"},
    {"id": "5", "groupe_nom": "H", "texte": SALE + " https://x.y"}, {"id": "6", "groupe_nom": "H", "texte": "une attestation perdue"},
]


def raw(spark, folder):
    with open(f"{folder}/20260801T000000Z_g.json", "w", encoding="utf-8") as f:
        json.dump(POSTS, f)
    return load_raw_posts(spark, f"{folder}/*.json")


def places(folder, run="1"):
    return Places(f"{folder}/maitre", f"{folder}/runs", f"{folder}/sorties/{run}", f"{folder}/vue")


def test_rules_only(spark, folder):
    found = rules_only_run(raw(spark, folder), f"{folder}/s", ORDER)
    assert sorted(r["id"] for r in found.collect()) == ["1", "6"]
    with pytest.raises(Exception):
        spark.read.parquet(f"{folder}/maitre")


def test_full_run_with_rules(spark, folder):
    posts = raw(spark, folder)
    row = full_run(spark, posts, places(folder), NOW, ORDER).first()
    assert tuple(row) == (6, 2, 1, f"{folder}/maitre", None)
    ad = load_master(spark, places(folder).master).first()
    assert (ad["id"], ad["quartier_zone"], ad["prix_fcfa"], ad["contacts_whatsapp"], ad["date_incertaine"]) == (
        "1", "Karpala", 9_000_000, ["70 11 22 33"], False)
    later = NOW + timedelta(days=1)
    full_run(spark, posts, places(folder, "2"), later, ORDER)
    ad = load_master(spark, places(folder).master).collect()
    assert len(ad) == 1 and (ad[0]["premiere_collecte"], ad[0]["derniere_maj"]) == (NOW, later)
    assert [r["nb_valides"] for r in load_runs(spark, places(folder).runs).collect()] == [1, 1]
    rejected = spark.read.json(f"{places(folder).out}/rejetes").groupBy("motif_rejet").count()
    assert {tuple(r) for r in rejected.collect()} == {("regex_niveau1", 3), ("llm_juge_invalide", 1)}


def refuse(text):
    return None


def test_an_empty_run_is_logged_and_raises_the_alert(spark, folder):
    posts = raw(spark, folder)
    for i in range(3):
        full_run(spark, posts, places(folder, str(i)), NOW + timedelta(days=i), ORDER)
    row = full_run(spark, posts.filter("false"), places(folder, "vide"), NOW + timedelta(days=4), ORDER).first()
    assert row["nb_posts_bruts"] == 0 and row["alerte_derive"].startswith("Low volume: 0 valid ads against 1.0")
    assert load_runs(spark, places(folder).runs).count() == 4 and load_master(spark, places(folder).master).count() == 1


def test_a_failing_extractor_loses_no_post(spark, folder):
    row = full_run(spark, raw(spark, folder), places(folder), NOW, ORDER, mode="backfill", extractor=refuse).first()
    assert (row["nb_candidats"], row["nb_valides"]) == (2, 0)
    rejected = spark.read.json(f"{places(folder).out}/rejetes").filter("motif_rejet = 'echec_api_ou_validation'")
    assert sorted(r["id"] for r in rejected.collect()) == ["1", "6"]


def test_no_master_folder_fails_before_any_call(spark, folder):
    def call(text):
        raise AssertionError("called")

    with pytest.raises(ValueError):
        full_run(spark, raw(spark, folder), Places("", "r", "o", "v"), NOW, ORDER, extractor=call)


def test_copies_and_unreadable_files_are_listed(spark, folder):
    posts = raw(spark, folder)
    issues = file_issues(spark.createDataFrame([("f", "[oops")], "_file STRING, value STRING"))
    full_run(spark, posts, places(folder), NOW, ORDER, issues=issues)
    assert [tuple(r) for r in spark.read.schema("id STRING, id_garde STRING").json(f"{places(folder).out}/doublons").collect()] == [("5", "1")]
    assert spark.read.json(f"{places(folder).out}/illisibles").first()["_file"] == "f"


def test_an_id_twice_in_a_run_is_once_in_the_master(spark, folder):
    rows = [("1", SALE, 0), ("1", SALE + " bis", 1), ("2", SALE + " ter", 2)]
    posts = spark.createDataFrame(rows, "id STRING, texte STRING, _pos BIGINT")
    full_run(spark, posts, places(folder), NOW, ["_pos"])
    stored = load_master(spark, places(folder).master).collect()
    assert {r["id"]: r["texte_nettoye"][-3:] for r in stored} == {"1": "bis", "2": "ter"} and len(stored) == 2
    assert [r["type_bien_inconnu"] for r in stored] == [False, False]


def test_phone_numbers_are_masked_in_every_file(spark, folder):
    full_run(spark, raw(spark, folder), places(folder), NOW, ORDER)
    out = places(folder).out
    for path, kind in ((f"{out}/annonces", "csv"), (places(folder).consult, "csv"), (f"{out}/rejetes", "json")):
        text = "\n".join(r["value"] for r in spark.read.text(path, recursiveFileLookup=True).collect())
        assert "70 11 22" not in text, path
    text = "\n".join(r["value"] for r in spark.read.text(f"{out}/annonces").collect())
    assert "tel **33" in text and "9 000 000 FCFA" in text


STREAM = "id STRING, prix_fcfa BIGINT, ts TIMESTAMP_NTZ, _pos BIGINT"


def arrive(spark, folder, *rows):
    spark.createDataFrame([(i, p, t, n) for n, (i, p, t) in enumerate(rows)], STREAM).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def test_stream_upsert_goes_on_after_a_stop(spark, folder):
    schema = spark.createDataFrame([], STREAM).schema
    arrive(spark, folder, ("a", 1, NOW), ("b", 2, NOW), ("a", 3, NOW))

    def go(now):
        upsert_stream(read_new_files(spark, f"{folder}/in", schema, 1), f"{folder}/m", f"{folder}/c", now).awaitTermination()
        return {r["id"]: (r["prix_fcfa"], r["premiere_collecte"]) for r in load_master(spark, f"{folder}/m").collect()}

    later = NOW + timedelta(days=1)
    assert go(NOW) == {"a": (3, NOW), "b": (2, NOW)}
    assert go(later) == {"a": (3, NOW), "b": (2, NOW)}
    arrive(spark, folder, ("a", 9, NOW), ("c", 4, NOW))
    assert go(later) == {"a": (9, NOW), "b": (2, NOW), "c": (4, later)}


def test_stream_keeps_the_first_row_of_every_id(spark, folder):
    """Late rows and rows without a time are kept like any other."""
    schema = spark.createDataFrame([], STREAM).schema
    arrive(spark, folder, ("a", 1, NOW), ("b", 2, NOW), ("n", 5, None), ("b", 7, NOW))

    def go():
        first_post_stream(read_new_files(spark, f"{folder}/in", schema, 1), f"{folder}/out", f"{folder}/c").awaitTermination()
        return {r["id"]: r["prix_fcfa"] for r in journal.read(spark, f"{folder}/out", schema).collect()}

    assert go() == {"a": 1, "b": 2, "n": 5}
    arrive(spark, folder, ("a", 3, NOW + timedelta(days=2)), ("tard", 4, NOW - timedelta(days=900)), ("n", 6, None), ("m", 8, None))
    assert go() == go() == {"a": 1, "b": 2, "n": 5, "tard": 4, "m": 8}
    assert journal.read(spark, f"{folder}/out", schema).count() == 5
    arrive(spark, folder, ("neuf", 9, NOW), ("a", 10, None))
    first_post_stream(read_new_files(spark, f"{folder}/in", schema, 1), f"{folder}/out", f"{folder}/autre").awaitTermination()
    assert {r["id"]: r["prix_fcfa"] for r in journal.read(spark, f"{folder}/out", schema).collect()} == {"a": 1, "b": 2, "n": 5, "tard": 4, "m": 8, "neuf": 9}
    assert journal.read(spark, f"{folder}/out", schema).count() == 6


def test_stream_forgets_ids_after_the_retention(spark, folder):
    """Against the first sighting, per batch; a row without a capture time never expires an id."""
    schema = spark.createDataFrame([], STREAM).schema
    days = [0, 5, 10, 11, None, 12, 25, 3]

    def go(checkpoint, seen_at="ts"):
        posts = read_new_files(spark, f"{folder}/in", schema, 1)
        first_post_stream(posts, f"{folder}/out", f"{folder}/{checkpoint}", seen_at=seen_at, retention=timedelta(days=10)).awaitTermination()
        return [tuple(r) for r in journal.read(spark, f"{folder}/out", schema).filter("id = 'a'").orderBy("prix_fcfa").select("prix_fcfa").collect()]

    for n, day in enumerate(days):
        arrive(spark, folder, ("a", n, None if day is None else NOW + timedelta(days=day)), (f"b{n}", n, None))
    assert go("c") == [(0,), (3,), (6,)]  # days 0, 11 and 25
    arrive(spark, folder, ("a", 8, NOW + timedelta(days=35)), ("b0", 9, NOW + timedelta(days=900)))
    assert go("autre") == [(0,), (3,), (6,)]  # a new checkpoint starts from what the output holds: day 25
    assert journal.read(spark, f"{folder}/out", schema).filter("id = 'b0'").count() == 1


def test_a_batch_that_is_run_again_counts_once(spark, folder):
    schema = spark.createDataFrame([], STREAM).schema

    def go():
        stream = read_new_files(spark, f"{folder}/in", schema, 1)
        first_post_stream(stream, f"{folder}/out", f"{folder}/c").awaitTermination()
        upsert_stream(stream, f"{folder}/m", f"{folder}/d", NOW).awaitTermination()
        kept = sorted(tuple(r) for r in journal.read(spark, f"{folder}/out", schema).select("id", "prix_fcfa").collect())
        return kept, sorted(tuple(r) for r in load_master(spark, f"{folder}/m").select("id", "prix_fcfa").collect())

    def forget_last_commit(checkpoint):
        last = max(int(os.path.basename(f)) for f in glob.glob(f"{folder}/{checkpoint}/flux/commits/*"))
        for name in (f"{last}", f".{last}.crc"):
            os.remove(f"{folder}/{checkpoint}/flux/commits/{name}")

    arrive(spark, folder, ("a", 1, NOW), ("b", 2, NOW))
    arrive(spark, folder, ("a", 3, NOW), ("c", 4, NOW))
    first = go()
    assert first == ([("a", 1), ("b", 2), ("c", 4)], [("a", 3), ("b", 2), ("c", 4)])
    versions = journal.versions(spark, f"{folder}/out"), journal.versions(spark, f"{folder}/m")
    for checkpoint in "cd":
        forget_last_commit(checkpoint)  # as if the driver had died after the write
    assert go() == first and (journal.versions(spark, f"{folder}/out"), journal.versions(spark, f"{folder}/m")) == versions
    arrive(spark, folder, ("b", 5, NOW), ("c", 6, NOW), ("d", 7, NOW))
    assert go() == ([("a", 1), ("b", 2), ("c", 4), ("d", 7)], [("a", 3), ("b", 5), ("c", 6), ("d", 7)])


def record(ident, text, **more):
    return {"id": ident, "comet_sections": {}, "message": {"text": text}, **more}


def test_from_captures_to_raw_posts(spark, folder):
    def page(group, *records, url="https://x/groups/1"):
        return group, url, f'<script type="application/json">{json.dumps(list(records))}</script>'

    seconds = int(NOW.timestamp())
    pages = spark.createDataFrame(
        [page("g", record("vieux", "épinglé", creation_time=1_500_000_000), record("a", "un")), page("bloque", record("x", "x"), url="https://x/checkpoint")],
        "groupe_id STRING, url STRING, html STRING")
    bodies = [
        ("g", 0, 0, json.dumps(record("a", "un")) + "\n" + json.dumps(record("b", "deux", creation_time=seconds - 60))),
        ("g", 1, 1, json.dumps([record("c", "trois", url="https://x/posts/c"), record("c", "trois bis")])),
        ("g", 2, 2, json.dumps(record("d", "quatre", creation_time=seconds - 10 * 86400))), ("g", 3, 3, json.dumps(record("e", "cinq"))),
    ]
    responses = spark.createDataFrame(bodies, "groupe_id STRING, step INT, response_pos INT, body STRING")
    groups = spark.createDataFrame([("g", "Groupe")], "id STRING, nom STRING")
    paths = f"{folder}/vus", f"{folder}/reperes", f"{folder}/brut"
    result = collect_posts(pages, responses, groups, *paths, NOW - timedelta(days=2), NOW, f"{folder}/pages_ecartees")
    assert result.groups.filter("groupe_id = 'g'").select("nb_posts", "etape_repere", "post_id").first()[:] == (6, None, "b")
    stored = load_raw_table(spark, paths[2]).orderBy("_pos").collect()
    assert [(r["id"], r["texte"], r["groupe_nom"]) for r in stored] == [
        ("vieux", "épinglé", "Groupe"), ("a", "un", "Groupe"), ("b", "deux", "Groupe"), ("c", "trois", "Groupe"), ("d", "quatre", "Groupe"), ("e", "cinq", "Groupe")]
    assert stored[0]["date_publication"] == "2017-07-14T02:40:00+00:00" and stored[3]["url"] == "https://x/posts/c" and stored[3]["date_incertaine"]
    assert [tuple(r)[:3] for r in spark.read.parquet(f"{folder}/pages_ecartees").collect()] == [("bloque", "https://x/checkpoint", "blocked")]
    assert sorted(r["id"] for r in load_seen(spark, paths[0]).collect()) == ["a", "b", "c", "d", "e", "vieux"]
    again = collect_posts(pages, responses, groups, *paths, NOW - timedelta(days=2), NOW + timedelta(hours=1))
    assert again.posts.count() == 0 and load_markers(spark, paths[1]).first()["post_id"] == "b"
    assert load_raw_table(spark, paths[2]).count() == 6


def test_answers_are_asked_for_once(spark, folder):
    calls = spark.sparkContext.accumulator(0)

    def extractor(text):
        calls.add(1)
        return None if text == "panne" else '{"est_une_annonce_valide": true, "type_bien": "villa"}'

    first = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "panne"), ("4", "a")], "id STRING, texte_nettoye STRING")
    assert {(r["id"], r["sortie_modele"] is None) for r in structure_once(first, extractor, f"{folder}/appels").collect()} == {
        ("1", False), ("2", False), ("3", True), ("4", False)}
    assert calls.value == 3
    more = first.unionByName(spark.createDataFrame([("5", "c")], "id STRING, texte_nettoye STRING"))
    assert structure_once(more, extractor, f"{folder}/appels").filter("sortie_modele IS NULL").count() == 1
    assert calls.value == 5


def test_health_scores_are_kept(spark, folder):
    runs = spark.createDataFrame([("a", NOW, 5, 5, False, False), ("b", NOW, 0, 0, True, False)],
                                 "source STRING, ts TIMESTAMP, anomalies BIGINT, total BIGINT, bloque BOOLEAN, session_expiree BOOLEAN")
    path = f"{folder}/sante"
    save_health(source_health(runs, load_health(spark, path)), path)
    save_health(source_health(runs.filter("source = 'a'"), load_health(spark, path)), path)
    scores = {r["source"]: (r["niveau_confiance"], r["cooldown_multiplicateur"]) for r in load_health(spark, path).collect()}
    assert scores == {"a": (0.25, 1), "b": (0.2, 2)}


def test_streamed_scores_equal_one_fold(spark, folder):
    ddl = "source STRING, ts TIMESTAMP, anomalies BIGINT, total BIGINT, bloque BOOLEAN, session_expiree BOOLEAN"
    rows = [(s, NOW + timedelta(hours=i), (i * 7 + len(s)) % 5, 5, i % 6 == 0, i % 4 == 0) for s in ("a", "bb", "ccc") for i in range(12)]
    for part in (rows[0:5] + rows[12:20], rows[5:9] + rows[24:30], rows[9:12] + rows[20:24] + rows[30:36]):
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    schema = spark.createDataFrame([], ddl).schema
    score_stream(read_new_files(spark, f"{folder}/in", schema, 1), f"{folder}/sante", f"{folder}/c").awaitTermination()
    columns = ["source", "niveau_confiance", "runs_propres_consecutifs", "cooldown_multiplicateur"]
    streamed = load_health(spark, f"{folder}/sante").select(*columns).orderBy("source").collect()
    assert streamed == source_health(spark.createDataFrame(rows, ddl)).select(*columns).orderBy("source").collect()


def test_ids_of_a_bucket_share_their_state(spark, folder, monkeypatch):
    monkeypatch.setattr(ingest, "BUCKETS", 3)
    schema = "id LONG, n LONG, _pos LONG"
    for i, rows in enumerate([[(k, 1, k) for k in range(40)] + [(k, 0, -1) for k in range(5)], [(k, 2, 100 + k) for k in range(30, 60)] + [(None, 3, 9), (None, 2, 8)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = read_new_files(spark, f"{folder}/in", spark.createDataFrame([], schema).schema, 1)
        query = first_post_stream(stream, f"{folder}/out", f"{folder}/c")
        query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3
    got = {r["id"]: r["n"] for r in journal.read(spark, f"{folder}/out", stream.schema).collect()}
    assert got == {k: 0 if k < 5 else 1 if k < 40 else 2 for k in [*range(60)]} | {None: 2}

import random
from datetime import datetime, timedelta

from adfeed.operators.captures import capture_counts, empty_group_samples, oldest_in_step
from adfeed.operators.catchup import new_posts
from adfeed.operators.markers import merge_markers, with_marker
from adfeed.operators.seen import next_seen, retain, unseen
from adfeed.schemas import MARKERS, SEEN

NOW = datetime(2026, 8, 1)
SCHEMA = "groupe_id STRING, step BIGINT, pos INT, id STRING, date_publication TIMESTAMP, featured BOOLEAN"


def day(n):
    return NOW - timedelta(days=n)


def run(spark, rows, seen=(), markers=(), cutoff=None):
    result = new_posts(
        spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame([(s, "x") for s in seen], SEEN),
        spark.createDataFrame(list(markers), MARKERS), cutoff or day(3),
    )
    posts = {(r["groupe_id"], r["id"]): (r["step"], r["pos"], r["featured"], r["apres_repere"], r["hors_fenetre"]) for r in result.posts.collect()}
    groups = {r["groupe_id"]: (r["nb_posts"], r["plus_ancien"], r["etape_repere"], r["post_id"]) for r in result.groups.collect()}
    return posts, groups


def test_nothing_captured_is_dropped(spark):
    """Far steps, long idle stretches, posts behind the marker or the window: all are kept and told apart."""
    rows = [("loin", s, 0, f"l{s}", None, False) for s in (0, 99, 100, 9300, 10**9)]
    rows += [("repere", s, 0, f"r{s}", day(s), False) for s in range(8)]
    posts, groups = run(spark, rows, markers=[("repere", "r5")])
    assert [posts["loin", f"l{s}"] for s in (0, 99, 100, 9300, 10**9)] == [(s, 0, False, False, False) for s in (0, 99, 100, 9300, 10**9)]
    assert [posts["repere", f"r{s}"][3:] for s in range(8)] == [(False, False)] * 4 + [(False, True)] * 2 + [(True, True)] * 2
    assert groups == {"loin": (5, None, None, "l0"), "repere": (8, day(7), 5, "r0")}


def test_first_place_and_known_posts(spark):
    rows = [
        ("une", None, 0, "u0", day(400), True), ("une", 0, 0, "u0", day(0), False), ("une", None, 1, "vu", None, True), ("une", 0, 1, "b", None, False),
        ("une", 2, 0, "b", day(9), False), ("connu", 0, 0, "vu", day(0), False), ("connu", 1, 0, "vu", day(0), False),
    ]
    posts, groups = run(spark, rows, {"vu"}, [("connu", "ancien"), ("une", "u9")])
    assert posts == {("une", "u0"): (None, 0, True, False, True), ("une", "b"): (0, 1, False, False, False)}
    assert groups == {"une": (2, None, None, "b"), "connu": (0, None, None, "ancien")}


def test_a_second_run_over_the_same_log_finds_nothing(spark):
    draw = random.Random(6)
    rows = [(f"g{draw.randrange(9)}", draw.randrange(200), p, f"p{draw.randrange(300)}", draw.choice([None, day(draw.random() * 9)]), False) for p in range(900)]
    posts, groups = run(spark, rows)
    assert posts.keys() == {(r[0], r[3]) for r in rows} and sum(g[0] for g in groups.values()) == len(posts)
    for (group, ident), (step, pos, *_) in posts.items():
        assert (step, pos) == min((r[1], r[2]) for r in rows if (r[0], r[3]) == (group, ident))
    again, after = run(spark, rows, {i for _, i in posts}, [(g, v[3]) for g, v in groups.items()])
    assert again == {} and {g: v[3] for g, v in after.items()} == {g: v[3] for g, v in groups.items()}


def test_seen_state(spark):
    seen = spark.createDataFrame(
        [("recent", "2026-07-31T00:00:00+00:00"), ("vieux", "2026-01-01T00:00:00+00:00"), ("limite", "2026-05-03T00:00:00+00:00"),
         ("illisible", "hier"), ("heure", "12:30"), ("nul", None)], SEEN)
    assert {r["id"] for r in retain(seen, NOW).collect()} == {"recent", "limite", "illisible", "heure", "nul"}
    posts = spark.createDataFrame([("recent", "2026-08-01T00:00:00+00:00"), ("neuf", "2026-08-01T00:00:00+00:00")], "id STRING, scrape_le STRING")
    assert [r["id"] for r in unseen(posts, seen).collect()] == ["neuf"]
    after = {r["id"]: r["vu_le_raw"] for r in next_seen(seen, posts, NOW).collect()}
    assert after["recent"].startswith("2026-07-31") and "neuf" in after and "vieux" not in after


def test_markers(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2")], MARKERS)
    new = spark.createDataFrame([("a", "9"), ("b", ""), ("c", "3"), ("d", None)], MARKERS)
    merged = merge_markers(old, new)
    assert {tuple(r) for r in merged.collect()} == {("a", "9"), ("b", "2"), ("c", "3")}
    groups = spark.createDataFrame([("a",), ("z",)], "groupe_id STRING")
    assert {tuple(r) for r in with_marker(groups, merged).collect()} == {("a", "9"), ("z", None)}


def test_counts_and_samples(spark):
    rows = [("a", 0, "https://x/api/graphql/1", "for (;;);abcdef"), ("a", 0, "https://x/img", "b"), ("b", 1, None, "c")] + [
        ("b", i, "https://x/api/graphql/", f"corps{i}") for i in range(2, 8)
    ]
    df = spark.createDataFrame(rows, "groupe_id STRING, step INT, url STRING, body STRING")
    counts = {tuple(r)[:2]: tuple(r)[2:] for r in capture_counts(df).collect()}
    assert counts[("a", 0)] == (2, 1) and counts[("b", 1)] == (1, 0)
    found = spark.createDataFrame([("a", 0), ("a", 0), ("c", 5)], "groupe_id STRING, step INT")
    with_posts = {tuple(r)[:2]: tuple(r)[2:] for r in capture_counts(df, posts=found).collect()}
    assert (with_posts["a", 0], with_posts["b", 1], with_posts["c", 5]) == ((2, 1, 2), (1, 0, 0), (0, 0, 1))
    records = spark.createDataFrame([("a",)], "groupe_id STRING")
    assert [r["corps_tronque"] for r in empty_group_samples(df, records, ["step"], chars=5).orderBy("rang").collect()] == ["c", "corps", "corps"]
    posts = spark.createDataFrame([("a", 0, NOW), ("a", 0, day(2)), ("a", 1, None)], "groupe_id STRING, step INT, date_publication TIMESTAMP")
    assert {tuple(r) for r in oldest_in_step(posts).collect()} == {("a", 0, day(2)), ("a", 1, None)}

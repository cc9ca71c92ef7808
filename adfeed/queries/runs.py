"""Run log, drift, health, state and master queries on the events table."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfeed.operators.filtering import funnel, tag_posts
from adfeed.operators.health import source_health
from adfeed.operators.markers import merge_markers, with_marker
from adfeed.operators.runs import check_drift, densify_days, drift_intervals, run_row, run_summary, volume_drift
from adfeed.operators.seen import next_seen, retain, unseen
from adfeed.operators.upsert import latest_first, merge_batch
from adfeed.queries.base import TEST_RULES, documents, events
from adfeed.queries.filtering import TAGGED, _KEPT
from adfeed.session import work_folder
from adfeed.sinks.tables import save_seen
from adfeed.sources.state import load_seen

DAY_10, DAY_20 = "2024-01-11", "2024-01-21"
NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)


def _posts(spark, folder) -> DataFrame:
    """Events as posts: the same user, type and payload is the same post."""
    post_id = F.concat_ws("-", F.col("user_id").cast("string"), "event_type", F.get_json_object("props", "$.k"))
    return events(spark, folder).select("event_id", "ts", "user_id", "event_type", "value", post_id.alias("id"))


def unseen_posts(spark, folder):
    posts = _posts(spark, folder)
    seen = posts.filter(F.col("ts") < F.lit(DAY_20).cast("timestamp")).select("id").distinct()
    recent = posts.filter(F.col("ts") >= F.lit(DAY_20).cast("timestamp"))
    return unseen(recent, seen).groupBy("id").agg(F.count("*").alias("nb"), F.min("event_id").alias("premier"))


def _seen_text():
    return F.when(F.col("event_type") == "error", F.lit("date illisible")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    )


def seen_retention(spark, folder):
    rows = _posts(spark, folder).select(F.col("event_id").cast("string").alias("id"), _seen_text().alias("vu_le_raw"))
    return retain(rows, NOW, 12)


def seen_update(spark, folder):
    posts = _posts(spark, folder).withColumn("scrape_le", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))
    is_old = F.col("ts") < F.lit(DAY_20).cast("timestamp")
    seen = posts.filter(is_old).groupBy("id").agg(F.min("scrape_le").alias("vu_le_raw"))
    return next_seen(seen, posts.filter(~is_old), NOW, 20)


def marker_merge(spark, folder):
    posts = _posts(spark, folder).withColumn("groupe_id", F.col("user_id").cast("string"))
    is_old = F.col("ts") < F.lit(DAY_10).cast("timestamp")
    last = F.max_by("event_id", "ts").cast("string").alias("post_id")
    old = posts.filter(is_old & (F.col("user_id") < 100)).groupBy("groupe_id").agg(last)
    new = posts.filter(~is_old).groupBy("groupe_id").agg(
        F.max_by(F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_id").cast("string")), "ts").alias("post_id")
    )
    groups = posts.select("groupe_id").distinct()
    return with_marker(groups, merge_markers(old, new))


def _master(spark, folder) -> DataFrame:
    """Three batches of thirds of the month, each in event order."""
    posts = _posts(spark, folder).withColumn(
        "id", F.concat_ws("-", F.col("user_id").cast("string"), "event_type")
    ).select("id", F.col("event_type").alias("groupe_nom"), F.col("value").alias("prix"), "event_id", "ts")
    master = posts.limit(0).select("id", "groupe_nom", "prix", F.col("ts").alias("premiere_collecte"), F.col("ts").alias("derniere_maj"))
    bounds = [None, DAY_10, DAY_20, None]
    for start, end in zip(bounds, bounds[1:]):
        batch = posts if start is None else posts.filter(F.col("ts") >= F.lit(start).cast("timestamp"))
        batch = batch if end is None else batch.filter(F.col("ts") < F.lit(end).cast("timestamp"))
        master = merge_batch(master, batch.drop("ts"), F.lit(end or "2024-02-01").cast("timestamp"), ["event_id"])
    return master


def master_upsert(spark, folder):
    return _master(spark, folder).select(
        "id", "groupe_nom", "prix", F.unix_micros("premiere_collecte").alias("premiere_us"), F.unix_micros("derniere_maj").alias("maj_us")
    )


def master_latest(spark, folder):
    return latest_first(_master(spark, folder)).select("id", "groupe_nom", "prix", F.unix_micros("derniere_maj").alias("maj_us"))


def _daily(spark, folder) -> DataFrame:
    counts = events(spark, folder).groupBy(F.col("user_id").alias("source"), F.to_date("ts").alias("horodatage")).agg(
        F.count_if(F.col("event_type") == "purchase").alias("nb_valides")
    )
    return densify_days(counts, ["source"], "horodatage", "nb_valides")


def volume_drift_query(spark, folder):
    return volume_drift(_daily(spark, folder)).select(
        "source", F.date_format("horodatage", "yyyy-MM-dd").alias("jour"), "nb_valides", "moyenne", "nb_historique",
        F.col("alerte").cast("int").alias("alerte"),
    )


def drift_alerts(spark, folder):
    """The alerts of the same counts as stretches of days; two rows with dates far off stretch nothing."""
    counts = events(spark, folder).groupBy(F.col("user_id").alias("source"), F.to_date("ts").alias("horodatage")).agg(
        F.count_if(F.col("event_type") == "purchase").alias("nb_valides")
    )
    far = spark.sql("SELECT -1L AS source, DATE'1970-01-01' AS horodatage, 5L AS nb_valides UNION ALL SELECT -2L, DATE'2999-01-01', 5L")
    found = drift_intervals(counts.unionByName(far.select(F.col("source").cast(counts.schema["source"].dataType), "horodatage", "nb_valides")))
    return found.filter("source >= 0").select(
        "source", F.date_format("debut", "yyyy-MM-dd").alias("debut"), F.date_format("fin", "yyyy-MM-dd").alias("fin"), "nb_valides"
    )


def seen_saved(spark, folder):
    """Two runs save what they saw, and the state is read back; days before the retention go."""
    path = work_folder(spark, "vus")
    posts = _posts(spark, folder).select("id", "ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("scrape_le"))
    late = F.col("ts") >= F.lit(DAY_20).cast("timestamp")
    save_seen(posts.filter(~late).select("id", "scrape_le"), path, NOW - timedelta(days=11), 20)
    save_seen(posts.filter(late).select("id", "scrape_le"), path, NOW, 20)
    return load_seen(spark, path)


def unseen_sketched(spark, folder):
    """New posts against a saved state of which only the days that may hold them are read."""
    path = work_folder(spark, "vus")
    posts = _posts(spark, folder).select("id", "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("scrape_le"), "ts")
    late = F.col("ts") >= F.lit(DAY_20).cast("timestamp")
    save_seen(posts.filter(~late), path, NOW)
    recent = posts.filter(late)
    return unseen(recent, load_seen(spark, path, recent)).groupBy("id").agg(F.count("*").alias("nb"), F.min("event_id").alias("premier"))


def _run_log(spark, folder) -> DataFrame:
    """One run per hour with events; errors make it a backfill run."""
    return events(spark, folder).groupBy(F.date_trunc("hour", "ts").alias("horodatage")).agg(
        F.when(F.count_if(F.col("event_type") == "error") > F.count("*") / 2, "backfill").otherwise("daily").alias("mode"),
        F.count_if(F.col("event_type") == "purchase").alias("nb_valides"),
    )


def drift_check_last(spark, folder):
    """The last run against the ones before it."""
    log = _run_log(spark, folder)
    last = log.agg(F.max("horodatage").alias("fin"), F.max_by("nb_valides", "horodatage").alias("n"))
    before = log.filter(F.col("horodatage") < last.select("fin").scalar())
    return check_drift(before, last.select("n").scalar()).select(
        "nb_valides", "moyenne", "nb_historique", F.col("alerte").cast("int").alias("alerte"), "message",
    )


def health_runs(spark, folder) -> DataFrame:
    """A run per user and day; its outcome from the events of that day."""
    def count(kind):
        return F.count_if(F.col("event_type") == kind)

    return events(spark, folder).groupBy(F.col("user_id").cast("string").alias("source"), F.date_trunc("day", "ts").alias("ts")).agg(
        count("error").alias("anomalies"), F.count("*").alias("total"),
        (count("signup") >= 2).alias("bloque"), ((count("view") >= 2) & (count("click") == 0)).alias("session_expiree"),
    )


def source_health_query(spark, folder):
    return source_health(health_runs(spark, folder)).select(
        "source", F.round("niveau_confiance", 9).alias("niveau_confiance"), "runs_propres_consecutifs",
        "cooldown_multiplicateur", F.round("delai_multiplicateur", 3).alias("delai_multiplicateur"),
    )


def run_log_row(spark, folder):
    tagged = tag_posts(documents(spark, folder), TEST_RULES).withColumn("_tous", F.lit(1))
    return run_row(funnel(tagged, ["_tous"], ["id"]), NOW, "daily").withColumn("horodatage", F.unix_micros("horodatage"))


def run_summary_query(spark, folder):
    tagged = tag_posts(documents(spark, folder), TEST_RULES).withColumn("_tous", F.lit(1))
    counts = funnel(tagged, ["_tous"], ["id"])
    runs = _run_log(spark, folder)
    drift = check_drift(runs, counts.select("nb_valides").scalar())
    return run_summary(counts, drift, "postgresql://adfeed:secret@hote/base")


QUERIES = {
    "unseen_posts": unseen_posts,
    "seen_retention": seen_retention,
    "seen_update": seen_update,
    "marker_merge": marker_merge,
    "master_upsert": master_upsert,
    "master_latest": master_latest,
    "volume_drift": volume_drift_query,
    "drift_alerts": drift_alerts,
    "seen_saved": seen_saved,
    "unseen_sketched": unseen_sketched,
    "drift_check_last": drift_check_last,
    "source_health": source_health_query,
    "run_log_row": run_log_row,
    "run_summary": run_summary_query,
}

_POSTS = "SELECT *, user_id || '-' || event_type || '-' || json_extract_string(props, '$.k') AS id FROM events"
_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
_MASTER_SQL = f"""
    SELECT user_id || '-' || event_type AS id, event_type AS groupe_nom, arg_max(value, event_id) AS prix,
        epoch_us(CASE WHEN min(ts) < TIMESTAMP '{DAY_10}' THEN TIMESTAMP '{DAY_10}'
            WHEN min(ts) < TIMESTAMP '{DAY_20}' THEN TIMESTAMP '{DAY_20}' ELSE TIMESTAMP '2024-02-01' END) AS premiere_us,
        epoch_us(CASE WHEN max(ts) < TIMESTAMP '{DAY_10}' THEN TIMESTAMP '{DAY_10}'
            WHEN max(ts) < TIMESTAMP '{DAY_20}' THEN TIMESTAMP '{DAY_20}' ELSE TIMESTAMP '2024-02-01' END) AS maj_us
    FROM events GROUP BY user_id, event_type"""
_DAILY_SQL = """
    SELECT u.source, u.jour, coalesce(c.n, 0) AS n
    FROM (SELECT source, unnest(generate_series(debut, (SELECT max(ts)::DATE FROM events), INTERVAL 1 DAY))::DATE AS jour
          FROM (SELECT user_id AS source, min(ts)::DATE AS debut FROM events GROUP BY 1)) u
    LEFT JOIN (SELECT user_id AS source, ts::DATE AS jour, count(*) FILTER (event_type = 'purchase') AS n FROM events GROUP BY 1, 2) c
        ON c.source = u.source AND c.jour = u.jour"""
_RUN_LOG_SQL = """
    SELECT date_trunc('hour', ts) AS horodatage, count(*) FILTER (event_type = 'purchase') AS nb_valides,
        CASE WHEN count(*) FILTER (event_type = 'error') > count(*) / 2 THEN 'backfill' ELSE 'daily' END AS mode
    FROM events GROUP BY 1"""


def _message_sql(count: str) -> str:
    return f"""'Low volume: ' || {count} || ' valid ads against ' || round_even(moyenne, 1)::DECIMAL(18, 1) || ' on average over the last '
        || nb_historique || ' daily runs (' || round_even(100 * {count} / moyenne, 0)::BIGINT || '% of the mean)'"""


def _history_sql(condition: str) -> str:
    return f"""SELECT avg(nb_valides) AS moyenne, count(*) AS nb_historique FROM
        (SELECT * FROM ({_RUN_LOG_SQL}) WHERE mode = 'daily' AND {condition} ORDER BY horodatage DESC LIMIT 7)"""


_BEFORE_LAST = "horodatage < (SELECT date_trunc('hour', max(ts)) FROM events)"
_TODAY_SQL = f"(SELECT arg_max(nb_valides, horodatage) FROM ({_RUN_LOG_SQL}))"
HEALTH_SQL = """
    WITH RECURSIVE runs AS (
        SELECT user_id::VARCHAR AS source, row_number() OVER (PARTITION BY user_id ORDER BY jour) AS n,
            CASE WHEN inscrits >= 2 THEN 'b' WHEN vues >= 2 AND clics = 0 THEN 'e' WHEN erreurs / total > 0.3 THEN 's' ELSE 'c' END AS issue
        FROM (SELECT user_id, ts::DATE AS jour, count(*) AS total, count(*) FILTER (event_type = 'error') AS erreurs,
                count(*) FILTER (event_type = 'signup') AS inscrits, count(*) FILTER (event_type = 'view') AS vues,
                count(*) FILTER (event_type = 'click') AS clics FROM events GROUP BY 1, 2)),
    fold AS (
        SELECT DISTINCT source, 0::BIGINT AS n, 1.0::DOUBLE AS conf, 0 AS serie, 1 AS mult FROM runs
        UNION ALL
        SELECT f.source, r.n,
            CASE issue WHEN 'b' THEN 0.2 WHEN 'e' THEN greatest(0.2, conf * 0.7) WHEN 's' THEN greatest(0.2, conf * 0.5)
                ELSE CASE WHEN serie + 1 >= 3 THEN least(1.0, conf + 0.15) ELSE conf END END::DOUBLE,
            CASE WHEN issue = 'c' AND serie + 1 < 3 THEN serie + 1 ELSE 0 END,
            CASE WHEN issue = 'b' THEN least(8, mult * 2) WHEN issue = 'c' AND serie + 1 >= 3 THEN 1 ELSE mult END
        FROM fold f JOIN runs r ON r.source = f.source AND r.n = f.n + 1)"""

_UNSEEN_SQL = f"""SELECT id, count(*) AS nb, min(event_id) AS premier FROM ({_POSTS}) p WHERE ts >= TIMESTAMP '{DAY_20}'
        AND NOT EXISTS (SELECT 1 FROM ({_POSTS}) s WHERE s.id = p.id AND s.ts < TIMESTAMP '{DAY_20}') GROUP BY 1"""

ORACLE = {
    "unseen_posts": _UNSEEN_SQL,
    "unseen_sketched": _UNSEEN_SQL,
    "seen_retention": f"""SELECT event_id::VARCHAR AS id, CASE WHEN event_type = 'error' THEN 'date illisible' ELSE {_ISO} END AS vu_le_raw
        FROM events WHERE event_type = 'error' OR ts >= TIMESTAMP '2024-01-31' - INTERVAL 12 DAY""",
    "seen_update": f"""SELECT id, min({_ISO}) AS vu_le_raw FROM ({_POSTS}) GROUP BY 1
        HAVING min(ts) >= TIMESTAMP '2024-01-31' - INTERVAL 20 DAY""",
    "marker_merge": f"""SELECT g.groupe_id, coalesce(n.post_id, o.post_id) AS post_id
        FROM (SELECT DISTINCT user_id::VARCHAR AS groupe_id FROM events) g
        LEFT JOIN (SELECT user_id::VARCHAR AS groupe_id, arg_max(event_id, ts)::VARCHAR AS post_id FROM events
            WHERE ts < TIMESTAMP '{DAY_10}' AND user_id < 100 GROUP BY 1) o USING (groupe_id)
        LEFT JOIN (SELECT user_id::VARCHAR AS groupe_id, nullif(arg_max(CASE event_type WHEN 'error' THEN '' ELSE event_id::VARCHAR END, ts), '') AS post_id
            FROM events WHERE ts >= TIMESTAMP '{DAY_10}' GROUP BY 1) n USING (groupe_id)""",
    "master_upsert": _MASTER_SQL,
    "master_latest": f"SELECT id, groupe_nom, prix, maj_us FROM ({_MASTER_SQL}) ORDER BY maj_us DESC, id",
    "volume_drift": f"""SELECT source, strftime(jour, '%Y-%m-%d') AS jour, n AS nb_valides, moyenne, h AS nb_historique,
            (h >= 3 AND coalesce(moyenne > 0 AND n < moyenne * 0.3, false))::INT AS alerte
        FROM (SELECT *, avg(n) OVER w AS moyenne, count(n) OVER w AS h FROM ({_DAILY_SQL})
            WINDOW w AS (PARTITION BY source ORDER BY jour ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""",
    # Days after a source's last one count as silent here until its history is empty, whatever the last day of all.
    "drift_alerts": """WITH c AS (SELECT user_id AS source, ts::DATE AS jour, count(*) FILTER (event_type = 'purchase') AS n FROM events GROUP BY 1, 2),
        u AS (SELECT source, unnest(generate_series(min(jour), max(jour) + INTERVAL 8 DAY, INTERVAL 1 DAY))::DATE AS jour FROM c GROUP BY 1),
        a AS (SELECT u.source, u.jour, c.n IS NULL AS vide, coalesce(c.n, 0) AS n FROM u LEFT JOIN c ON c.source = u.source AND c.jour = u.jour),
        v AS (SELECT *, avg(n) OVER w AS moyenne, count(*) OVER w AS h FROM a WINDOW w AS (PARTITION BY source ORDER BY jour ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
        x AS (SELECT *, jour - (row_number() OVER (PARTITION BY source, vide ORDER BY jour))::INT AS ile FROM v WHERE h >= 3 AND moyenne > 0 AND n < moyenne * 0.3)
        SELECT source, strftime(min(jour), '%Y-%m-%d') AS debut, strftime(max(jour), '%Y-%m-%d') AS fin, min(n) AS nb_valides
        FROM x GROUP BY source, CASE WHEN vide THEN ile END, CASE WHEN NOT vide THEN jour END""",
    "seen_saved": f"""SELECT id, min({_ISO}) AS vu_le_raw FROM ({_POSTS}) GROUP BY 1 HAVING min(ts)::DATE >= DATE '2024-01-11'""",
    "drift_check_last": f"""SELECT t AS nb_valides, moyenne, nb_historique, a::INT AS alerte,
            CASE WHEN a THEN {_message_sql('t')} END AS message
        FROM (SELECT *, {_TODAY_SQL} AS t, nb_historique >= 3 AND moyenne > 0 AND {_TODAY_SQL} < moyenne * 0.3 AS a FROM ({_history_sql(_BEFORE_LAST)}))""",
    "source_health": f"""{HEALTH_SQL} SELECT source, round(conf, 9) AS niveau_confiance, serie AS runs_propres_consecutifs,
            mult AS cooldown_multiplicateur, round(1 / conf, 3) AS delai_multiplicateur
        FROM fold QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC) = 1""",
    "run_log_row": f"""SELECT epoch_us(TIMESTAMP '2024-01-31') AS horodatage, 'daily' AS mode,
            (SELECT count(*) FROM documents) AS nb_posts_bruts, (SELECT count(*) FROM ({_KEPT})) AS nb_candidats, 0::BIGINT AS nb_valides""",
    "run_summary": f"""SELECT (SELECT count(*) FROM ({TAGGED})) AS nb_posts_bruts, (SELECT count(*) FROM ({_KEPT})) AS nb_candidats,
            0::BIGINT AS nb_valides, 'postgresql://adfeed:***@hote/base' AS base_maitre,
            CASE WHEN nb_historique >= 3 AND moyenne > 0 THEN {_message_sql('0')} END AS alerte_derive FROM ({_history_sql('true')})""",
}

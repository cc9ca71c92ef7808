"""Record discovery, dates and new posts on pages, conversations and events."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfeed.functions.dates import epoch_ts, parse_relative_ts, window_cutoff
from adfeed.functions.text import body_documents
from adfeed.operators.captures import capture_counts, empty_group_samples, oldest_in_step
from adfeed.operators.catchup import Catchup, new_posts
from adfeed.operators.records import body_records, html_blobs, page_records, unread_blobs, unread_bodies, with_group
from adfeed.queries.base import events, table
from adfeed.session import spread, with_computed

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
BASE_TIME = 1_700_000_000


def html_blobs_query(spark, folder):
    """Two scripts per page hold the page's own text and address; a third has another type."""
    pages = table(spark, folder, "pages").select(
        "page_id",
        F.concat(
            "html", F.lit('<script type="application/json" data-x>'), F.replace("html", F.lit("<"), F.lit("(")),
            F.lit('</script><SCRIPT type="application/json">no</SCRIPT><script type="application/json">'), "url",
            F.lit('\n2</script><script type="text/json">no</script>'),
        ).alias("html"),
    )
    return html_blobs(pages, ["page_id"])


def _pages_with_records(spark, folder) -> DataFrame:
    """Pages that embed a nested record, a broken script and a script with three records."""
    page = F.col("page_id").cast("string")
    text = F.replace("html", F.lit("<"), F.lit(" "))

    def ident(prefix):
        return F.concat(F.lit(prefix), page).alias("id")

    def message(col):
        return F.struct(col.alias("text")).alias("message")

    profile = F.struct(F.struct(F.lit("https://exemple.test/u/1").alias("url"), F.lit(True).alias("creation_time")).alias("story"))
    place = F.struct(
        F.struct(
            F.concat(F.lit("https://exemple.test/posts/"), page).alias("url"), (BASE_TIME + F.col("page_id")).alias("creation_time")
        ).alias("story")
    )
    sections = F.struct(
        F.struct(F.struct(message(text)).alias("story")).alias("content"), profile.alias("context"), F.array(place).alias("metadata")
    )
    nested = F.struct(
        F.struct(ident("p"), F.lit(5).alias("creation_time"), F.struct(ident("a"), sections.alias("comet_sections")).alias("attached_story")).alias("node")
    )
    several = F.struct(
        F.array(
            F.struct(ident("a"), F.lit("x").alias("comet_sections"), message(F.lit("again"))),
            F.struct(ident("r"), F.lit("x").alias("comet_sections"), message(F.col("url"))),
            F.struct(ident("n"), F.lit("x").alias("comet_sections"), message(F.lit("  "))),
        ).alias("items")
    )
    start, end = F.lit('<script type="application/json">'), F.lit("</script>")
    html = F.concat("html", start, F.to_json(nested), end, start, F.lit('{"a": oops'), end, start, F.to_json(several), end)
    pages = with_computed(table(spark, folder, "pages"), "complet", html)
    return pages.select("page_id", "url", F.col("complet").alias("html"))


def page_records_query(spark, folder):
    found = page_records(_pages_with_records(spark, folder), ["page_id"], NOW)
    return found.select(
        "page_id", "blob_pos", "rec_pos", "id", "url", "texte", F.unix_micros("date_publication").alias("publie_us"),
        F.col("date_incertaine").cast("int").alias("date_incertaine"), "scrape_le",
    )


def deep_records(spark, folder):
    """A record for each page below 13 to 112 levels, every hundredth below 60,001, its text 20 levels further down."""
    levels = F.when(F.col("page_id") % 100 == 0, F.lit(60_001)).otherwise(F.col("page_id") % 100 + 13).cast("int")
    inner = F.concat(F.repeat(F.lit('{"n": '), F.lit(20)), F.lit('{"message": '), F.to_json(F.struct(F.col("url").alias("text"))), F.lit("}"), F.repeat(F.lit("}"), F.lit(20)))
    record = F.concat(F.lit('{"id": "'), F.col("page_id").cast("string"), F.lit('", "comet_sections": '), inner, F.lit("}"))
    script = F.concat(F.lit('<script type="application/json">'), F.repeat(F.lit("["), levels), record, F.repeat(F.lit("]"), levels), F.lit("</script>"))
    pages = with_computed(table(spark, folder, "pages").select("page_id", "url"), "html", script)
    return page_records(pages, ["page_id"], NOW).select("page_id", "id", "texte")


def long_numbers(spark, folder):
    """A record for each page beside a number of 5,000 digits and more, which JSON allows."""
    number = F.concat(F.lit("9"), F.repeat(F.lit("7"), F.lit(5000) + (F.col("page_id") % 7).cast("int")))
    record = F.concat(F.lit('{"id": "'), F.col("page_id").cast("string"), F.lit('", "comet_sections": '), number, F.lit(', "message": '), F.to_json(F.struct(F.col("url").alias("text"))), F.lit("}"))
    script = F.concat(F.lit('<script type="application/json">[1, '), record, F.lit("]</script>"))
    pages = with_computed(table(spark, folder, "pages").select("page_id", "url"), "html", script)
    return page_records(pages, ["page_id"], NOW).select("page_id", "id", "texte")


def unread_scripts(spark, folder):
    """Scripts of the pages that are no JSON."""
    return unread_blobs(_pages_with_records(spark, folder), ["page_id"]).select("page_id", "blob_pos", F.md5("json").alias("json_md5"))


def unread_lines(spark, folder):
    """Lines of response bodies that are no JSON."""
    return unread_bodies(_responses(spark, folder), ["conv_id", "turn"]).select("conv_id", "turn", "json")


def _responses(spark, folder) -> DataFrame:
    """Turns as response bodies: one line for users, several lines otherwise."""
    ident = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))

    def record(prefix, col):
        return F.to_json(F.struct(F.concat(F.lit(prefix), ident).alias("id"), F.lit(1).alias("comet_sections"), F.struct(col.alias("text")).alias("message")))

    one = record("u", F.col("text"))
    several = F.concat(record("v", F.col("text")), F.lit("\r\n{broken\n\n  "), record("w", F.col("role")))
    body = F.concat(F.lit("for (;;);"), F.when(F.col("role") == "user", one).otherwise(several))
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return with_computed(turns, "body", body).select("conv_id", "turn", F.col("role").alias("groupe_id"), "body")


def body_documents_query(spark, folder):
    turns = table(spark, folder, "conversations")
    body = F.concat(F.lit("for (;;);"), "role", F.lit("\r\n " + chr(11)), "text", F.lit(chr(30)), "role")
    return turns.select("conv_id", "turn", F.posexplode(body_documents(body)).alias("doc_pos", "document"))


def body_records_query(spark, folder):
    groups = _groups(spark, folder)
    found = body_records(_responses(spark, folder), ["conv_id", "turn", "groupe_id"], NOW)
    return with_group(found, groups).select("conv_id", "turn", "groupe_nom", "id", "texte")


def _groups(spark, folder) -> DataFrame:
    """The roles as groups, with a name each."""
    return table(spark, folder, "conversations").select(F.col("role").alias("id")).distinct().select("id", F.upper("id").alias("nom"))


_MONTH_NAMES = [
    "janvier", "février", "fevrier", "mars", "avril", "mai", "juin", "juillet", "août", "aout", "septembre", "octobre", "novembre", "décembre", "decembre",
]


def relative_dates(spark, folder):
    """A date text per event, seen at the event's time; some name impossible days and hours."""
    k = F.get_json_object("props", "$.k")
    month = F.element_at(F.array(*[F.lit(m) for m in _MONTH_NAMES]), (F.col("user_id") % len(_MONTH_NAMES) + 1).cast("int"))
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.concat(k, F.lit(" min")))
        .when(kind == "view", F.concat(F.lit(" "), k, F.lit("H ")))
        .when(kind == "error", F.concat(F.lit("Hier à "), k, F.lit("h"), F.lpad(F.col("user_id").cast("string"), 2, "0")))
        .when(kind == "signup", F.concat(k, F.lit(" "), F.initcap(month), F.lit(" 2023 a 9:05")))
        .otherwise(F.concat(k, F.lit("  "), month))
    )
    return spread(events(spark, folder)).select("event_id", F.unix_micros(parse_relative_ts(text, F.col("ts"))).alias("date_us"))


def epoch_dates(spark, folder):
    seconds = F.unix_micros("ts") / 1e6
    kind = F.col("event_type")
    stored = (
        F.when(kind == "click", seconds).when(kind == "view", F.floor(seconds).cast("double"))
        .when(kind == "error", F.col("value")).when(kind == "signup", seconds * 1e6)
    )
    at = epoch_ts(stored)
    return events(spark, folder).select("event_id", F.unix_micros(at).alias("date_us"), at.isNull().cast("int").alias("date_incertaine"))


def _captures(spark, folder) -> DataFrame:
    """A feed per event type, read back from the end of the month in steps of one hour.

    Post ids are event ids or, for two types, user ids, which soon repeat; one
    type has no dates.
    """
    by_user = F.col("event_type").isin("error", "signup")
    featured = F.get_json_object("props", "$.k") == "7"
    step = F.floor((F.unix_micros(F.lit(NOW)) - F.unix_micros("ts")) / 3_600_000_000)
    return events(spark, folder).select(
        F.col("event_type").alias("groupe_id"), F.when(~featured, step).alias("step"), (-F.col("event_id")).alias("pos"),
        F.when(by_user, F.col("user_id")).otherwise(F.col("event_id") + 1_000_000_000).cast("string").alias("id"),
        F.when(F.col("event_type") != "view", F.col("ts")).alias("date_publication"), featured.alias("featured"),
    )


def _catchup(spark, folder) -> Catchup:
    captures = _captures(spark, folder)
    seen = table(spark, folder, "events").filter("user_id < 75").select(F.col("user_id").cast("string").alias("id")).distinct()
    markers = (
        captures.filter((F.col("groupe_id") == "click") & (F.col("date_publication") < F.lit(NOW - timedelta(days=2))))
        .groupBy("groupe_id").agg(F.max_by("id", "date_publication").alias("post_id"))
    )
    return new_posts(captures, seen, markers, window_cutoff(NOW, days_back=3))


def feed_catchup_posts(spark, folder):
    return _catchup(spark, folder).posts.select(
        "groupe_id", "id", F.coalesce("step", F.lit(-1)).alias("step"), "pos", F.col("featured").cast("int").alias("featured"),
        F.unix_micros("date_publication").alias("date_us"), F.col("apres_repere").cast("int").alias("apres_repere"),
        F.col("hors_fenetre").cast("int").alias("hors_fenetre"),
    )


def feed_catchup_groups(spark, folder):
    return _catchup(spark, folder).groups.select(
        "groupe_id", "nb_posts", F.unix_micros("plus_ancien").alias("plus_ancien_us"), F.coalesce("etape_repere", F.lit(-1)).alias("etape_repere"), "post_id"
    )


def oldest_in_step_query(spark, folder):
    found = oldest_in_step(_captures(spark, folder).filter("NOT featured"))
    return found.select("groupe_id", "step", F.unix_micros("plus_ancien").alias("plus_ancien_us"))


def capture_counts_query(spark, folder):
    """A step for every tenth page number; the pages of one language stand for those with posts."""
    step = F.floor(F.col("page_id") / 10).alias("step")
    pages = table(spark, folder, "pages").select(F.regexp_extract("url", "/(fr|de|en|es)/", 1).alias("groupe_id"), step, "url", "page_id")
    return capture_counts(pages, ["groupe_id", "step"], ["?page="], pages.filter("page_id % 3 = 0"))


def empty_group_samples_query(spark, folder):
    responses = table(spark, folder, "conversations").select(
        F.col("role").alias("groupe_id"), "conv_id", "turn", F.lit("/api/").alias("url"), F.concat(F.lit("for (;;);"), "text").alias("body")
    )
    records = responses.filter("groupe_id = 'user'")
    found = empty_group_samples(responses, records, ["conv_id", "turn"], chars=120)
    return found.withColumn("rang", F.col("rang").cast("bigint"))


QUERIES = {
    "html_blobs": html_blobs_query,
    "page_records": page_records_query,
    "deep_records": deep_records,
    "long_numbers": long_numbers,
    "unread_scripts": unread_scripts,
    "unread_lines": unread_lines,
    "body_documents": body_documents_query,
    "body_records": body_records_query,
    "relative_dates": relative_dates,
    "epoch_dates": epoch_dates,
    "feed_catchup_posts": feed_catchup_posts,
    "feed_catchup_groups": feed_catchup_groups,
    "oldest_in_step": oldest_in_step_query,
    "capture_counts": capture_counts_query,
    "empty_group_samples": empty_group_samples_query,
}

# The month of each name the query can pick, in the order of the names.
_MONTH_CASE = "([1, 2, 2, 3, 4, 5, 6, 7, 8, 8, 9, 10, 11, 12, 12])[user_id % 15 + 1]"
_CLOCK_TS = "TRY_CAST(printf('%s %02d:%02d:00', {day}, {hour}, {minute}) AS TIMESTAMP)"


def _calendar_sql(year: str, clock: str) -> str:
    return f"TRY_CAST(printf('%04d-%02d-%02d {clock}:00', {year}, m, k) AS TIMESTAMP)"


_FEED_SQL = """
    WITH captures AS (
        SELECT event_type AS groupe_id, json_extract_string(props, '$.k') = '7' AS featured,
            floor((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(ts)) / 3600000000)::BIGINT AS step, -event_id AS pos,
            CASE WHEN event_type IN ('error', 'signup') THEN user_id ELSE event_id + 1000000000 END::VARCHAR AS id,
            CASE WHEN event_type <> 'view' THEN ts END AS d
        FROM events),
    marker AS (
        SELECT groupe_id, arg_max(id, d) AS post_id FROM captures
        WHERE groupe_id = 'click' AND d < TIMESTAMP '2024-01-31' - INTERVAL 2 DAY GROUP BY 1),
    shown AS (SELECT groupe_id, min(step) AS etape FROM captures JOIN marker USING (groupe_id) WHERE id = post_id AND NOT featured GROUP BY 1),
    fresh AS (
        SELECT * FROM captures WHERE id NOT IN (SELECT user_id::VARCHAR FROM events WHERE user_id < 75)
        QUALIFY row_number() OVER (PARTITION BY groupe_id, id ORDER BY featured DESC, CASE WHEN featured THEN 0 ELSE step END, pos) = 1),
    posts AS (
        SELECT groupe_id, id, CASE WHEN featured THEN -1 ELSE step END AS step, pos, d, featured,
            coalesce(NOT featured AND step > etape, false) AS apres_repere, coalesce(d < TIMESTAMP '2024-01-31' - INTERVAL 3 DAY, false) AS hors_fenetre
        FROM fresh LEFT JOIN shown USING (groupe_id))
"""

ORACLE = {
    "html_blobs": """SELECT page_id, unnest([0, 1]) AS blob_pos, unnest([replace(html, '<', '('), url || chr(10) || '2']) AS json FROM pages""",
    "page_records": f"""SELECT page_id, 0 AS blob_pos, 0 AS rec_pos, 'a' || page_id AS id, 'https://exemple.test/posts/' || page_id AS url,
            replace(html, '<', ' ') AS texte, (({BASE_TIME} + page_id) * 1000000)::BIGINT AS publie_us, 0 AS date_incertaine,
            '2024-01-31T00:00:00+00:00' AS scrape_le FROM pages
        UNION ALL SELECT page_id, 2, 1, 'r' || page_id, NULL, url, NULL, 1, '2024-01-31T00:00:00+00:00' FROM pages""",
    "long_numbers": "SELECT page_id, page_id::VARCHAR AS id, url AS texte FROM pages",
    "unread_scripts": """SELECT page_id, 1 AS blob_pos, md5('{"a": oops') AS json_md5 FROM pages""",
    "unread_lines": "SELECT conv_id, turn, '{broken' AS json FROM conversations WHERE role <> 'user'",
    "deep_records": "SELECT page_id, page_id::VARCHAR AS id, url AS texte FROM pages",
    "body_documents": r"""SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id, turn ORDER BY premier) - 1)::INT AS doc_pos, document
        FROM (SELECT conv_id, turn, document, min(i) AS premier FROM
            (SELECT conv_id, turn, i, regexp_replace(p, '^[\s\x0b\x1c-\x1f\x{85}\p{Z}]+|[\s\x0b\x1c-\x1f\x{85}\p{Z}]+$', '', 'g') AS document FROM
                (SELECT conv_id, turn, unnest(parts) AS p, generate_subscripts(parts, 1) AS i FROM
                    (SELECT conv_id, turn, list_prepend(b, regexp_split_to_array(b, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]')) AS parts FROM
                        (SELECT conv_id, turn, role || chr(13) || chr(10) || ' ' || chr(11) || text || chr(30) || role AS b FROM conversations))))
            WHERE document <> '' GROUP BY 1, 2, 3)""",
    "body_records": """SELECT conv_id, turn, upper(role) AS groupe_nom,
            CASE role WHEN 'user' THEN 'u' ELSE 'v' END || conv_id || '-' || turn AS id, text AS texte FROM conversations
        UNION ALL SELECT conv_id, turn, upper(role), 'w' || conv_id || '-' || turn, role FROM conversations WHERE role <> 'user'""",
    "relative_dates": f"""SELECT event_id, epoch_us(CASE event_type
            WHEN 'click' THEN ts - to_minutes(k)
            WHEN 'view' THEN ts - to_hours(k)
            -- DuckDB reads 24:00:00 as the next midnight; there is no such hour
            WHEN 'error' THEN CASE WHEN k < 24 THEN {_CLOCK_TS.format(day="strftime(ts::DATE - 1, '%Y-%m-%d')", hour='k', minute="lpad(user_id::VARCHAR, 2, '0')::INT")} END
            WHEN 'signup' THEN {_calendar_sql('2023', '09:05')}
            ELSE CASE WHEN {_calendar_sql('2024', '12:00')} > ts THEN {_calendar_sql('2023', '12:00')} ELSE {_calendar_sql('2024', '12:00')} END
            END) AS date_us
        FROM (SELECT *, json_extract_string(props, '$.k')::INT AS k, {_MONTH_CASE} AS m FROM events)""",
    "epoch_dates": """SELECT event_id, CASE event_type WHEN 'click' THEN epoch_us(ts) WHEN 'view' THEN epoch_us(date_trunc('second', ts)) END AS date_us,
            (event_type NOT IN ('click', 'view'))::INT AS date_incertaine FROM events""",
    "feed_catchup_posts": f"""{_FEED_SQL} SELECT groupe_id, id, step, pos, featured::INT AS featured, epoch_us(d) AS date_us,
            apres_repere::INT AS apres_repere, hors_fenetre::INT AS hors_fenetre FROM posts""",
    "feed_catchup_groups": f"""{_FEED_SQL} SELECT g.groupe_id, coalesce(p.nb, 0) AS nb_posts, epoch_us(p.ancien) AS plus_ancien_us,
            coalesce(s.etape, -1) AS etape_repere, coalesce(p.premier, k.post_id) AS post_id
        FROM (SELECT DISTINCT groupe_id FROM captures) g LEFT JOIN (SELECT groupe_id, count(*) AS nb, min(d) FILTER (NOT featured) AS ancien,
            arg_min(id, step * 1000000000000 + pos) FILTER (NOT featured) AS premier FROM posts GROUP BY 1) p USING (groupe_id)
        LEFT JOIN shown s USING (groupe_id) LEFT JOIN marker k USING (groupe_id)""",
    "oldest_in_step": f"""{_FEED_SQL} SELECT groupe_id, step, epoch_us(min(d)) AS plus_ancien_us FROM captures WHERE NOT featured GROUP BY 1, 2""",
    "capture_counts": """SELECT regexp_extract(url, '/(fr|de|en|es)/', 1) AS groupe_id, page_id // 10 AS step, count(*) AS reponses_vues,
            count(*) FILTER (contains(url, '?page=')) AS reponses_retenues, count(*) FILTER (page_id % 3 = 0) AS nb_posts FROM pages GROUP BY 1, 2""",
    "empty_group_samples": """SELECT role AS groupe_id, rang, '/api/' AS url, substring(text, 1, 120) AS corps_tronque
        FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS rang FROM conversations WHERE role <> 'user') WHERE rang <= 3""",
}

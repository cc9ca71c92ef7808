"""Files, tables, streams and whole runs, written to the work folder and read back."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfeed.operators.filtering import rejects, tag_posts
from adfeed.operators.structure import invalid_posts, route, valid_ads
from adfeed.plans.runs import Places, collect_posts, full_run, rules_only_run
from adfeed.queries.base import TEST_RULES, documents, events, sql_search, sql_words, table
from adfeed.queries.collection import BASE_TIME, _pages_with_records, _responses
from adfeed.queries.filtering import TAGGED, _KEPT
from adfeed.queries.runs import HEALTH_SQL, health_runs
from adfeed.queries.structuring import _ROUTED_SQL, _answers
from adfeed.schemas import AD_COLUMNS, CANDIDATE_COLUMNS, MASTER
from adfeed.session import work_folder
from adfeed.sinks.exports import export_ads, export_master, write_rejects
from adfeed.sinks.tables import append_raw, upsert_master
from adfeed.sources import journal
from adfeed.sources.groups import load_groups
from adfeed.sources.posts import file_issues, line_issues, load_large_posts, load_raw_post_lines, load_raw_posts, load_raw_table, merge_posts, parse_post_files
from adfeed.sources.state import load_health, load_master
from adfeed.streaming.ingest import first_post_stream, read_new_files, score_stream, upsert_stream

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
LATER = datetime(2024, 2, 1, tzinfo=timezone.utc)


def _group_file(spark, folder) -> str:
    """Suppliers as a group list in CSV, with placeholders and inactive groups."""
    path = work_folder(spark, "groupes")
    balance = F.col("s_acctbal")
    rows = table(spark, folder, "supplier").select(
        F.lit("x").alias("membres"),
        F.when(balance < 0, F.lit("Vrai ")).when(balance < 5000, F.lit("1")).when(balance < 8000, F.lit("non")).otherwise("true").alias("actif"),
        F.concat(F.when(balance > 9000, F.lit(" todo_")).otherwise(" "), F.col("s_suppkey").cast("string")).alias("id"),
        F.concat("s_name", F.lit(', "suite" ')).alias("nom"), F.lit(" https://exemple.test/groups ").alias("url"),
    )
    rows.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


def active_groups_query(spark, folder):
    return load_groups(spark, _group_file(spark, folder)).withColumn("actif", F.col("actif").cast("int"))


def first_groups(spark, folder):
    """The first seven in the order of the file (a limit is the feature)."""
    return load_groups(spark, _group_file(spark, folder), 7).select("id", "nom")


def _post_files(spark, folder) -> DataFrame:
    """Each document as a raw file: its lines are posts whose ids repeat across files.

    German files are cut short and the first post of Spanish files has no id.
    """
    def post(line, i):
        ident = F.when((F.col("lang") != "es") | (i > 0), F.concat("source", F.lit("-"), i.cast("string")))
        return F.struct(ident.alias("id"), F.col("source").alias("groupe_id"), line.alias("texte"))

    array = F.to_json(F.transform(F.split("text", "\n"), post))
    value = F.when(F.col("lang") == "de", F.expr("left(a, length(a) - 1)")).otherwise(F.col("a"))
    rows = table(spark, folder, "documents").select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("_file"), "lang", array.alias("a"))
    return rows.select("_file", value.alias("value"))


def raw_posts_merge(spark, folder):
    return merge_posts(parse_post_files(_post_files(spark, folder))).select("id", "texte", "_file", "_pos")


def raw_file_issues(spark, folder):
    issues = file_issues(_post_files(spark, folder))
    return issues.select("_file", F.col("lisible").cast("int").alias("lisible"), "sans_id")


def _line_files(spark, folder) -> str:
    """A file of lines for each source: posts that repeat ids, cut lines and lines without an id."""
    path = work_folder(spark, "lignes")
    ident = F.when(F.col("lang") != "es", F.concat_ws("-", "source", (F.col("doc_id") % 100).cast("string")))
    post = F.to_json(F.struct(ident.alias("id"), F.col("source").alias("groupe_id"), F.col("text").alias("texte"), F.col("doc_id").alias("_pos")))
    line = F.when(F.col("lang") == "de", F.expr("left(p, length(p) - 1)")).otherwise(F.col("p"))
    rows = table(spark, folder, "documents").withColumn("p", post).select("source", line.alias("value"))
    rows.repartition("source").write.partitionBy("source").text(path)
    return path


def raw_post_lines(spark, folder):
    """Of an id the last line of the last file counts; ids hold their source, so files do not matter."""
    return load_raw_post_lines(spark, _line_files(spark, folder)).select("id", "groupe_id", "texte")


def raw_line_issues(spark, folder):
    issues = line_issues(spark, _line_files(spark, folder))
    return issues.select(F.col("lisible").cast("int").alias("lisible"), F.md5("value").alias("ligne_md5"))


def _array_files(spark, folder) -> str:
    """The documents as array files on disk, one for each source; posts are objects in objects, and texts full of braces."""
    path = work_folder(spark, "tableaux")
    post = F.to_json(F.struct(
        F.concat_ws("-", "source", (F.col("doc_id") % 200).cast("string")).alias("id"), F.col("source").alias("groupe_id"),
        F.concat(F.col("text"), F.lit('}, {"\\')).alias("texte"), F.struct(F.array(F.lit("]")).alias("}")).alias("autre"),
    ))
    order = Window.partitionBy("source").orderBy("doc_id")
    rows = table(spark, folder, "documents").select(
        "source", "doc_id", post.alias("p"), F.row_number().over(order).alias("n"), F.lead("doc_id").over(order).isNull().alias("fin")
    )
    line = F.concat(F.when(F.col("n") == 1, "[").otherwise(","), "p", F.when(F.col("fin"), "]").otherwise(""))
    # The window has left the rows of a source in one task, in order.
    rows.select("source", line.alias("value")).write.partitionBy("source").text(path)
    return path


def raw_files_load(spark, folder):
    """Array files read whole: of an id the last post, at the place of its first."""
    return load_raw_posts(spark, _array_files(spark, folder)).select("id", "groupe_id", F.md5("texte").alias("texte_md5"), "_pos")


def raw_files_split(spark, folder):
    """The same files read block by block."""
    return load_large_posts(spark, _array_files(spark, folder)).select("id", "groupe_id", F.md5("texte").alias("texte_md5"), "_pos")


def raw_append_read(spark, folder):
    """Two runs appended by group; the second corrects some posts of the first."""
    path = work_folder(spark, "brut")
    posts = table(spark, folder, "conversations").select(
        F.col("conv_id").cast("string").alias("id"), F.col("role").alias("groupe_id"), F.lit("").alias("groupe_nom"),
        F.lit(None).cast("string").alias("url"), F.col("text").alias("texte"), F.lit(None).cast("string").alias("date_publication"),
        F.lit(True).alias("date_incertaine"), F.lit("").alias("scrape_le"), F.array("turn").alias("_pos"),
    )
    append_raw(posts.filter("groupe_id <> 'assistant'"), path, "20240101T000000Z")
    append_raw(posts.filter("groupe_id = 'assistant'"), path, "20240102T000000Z")
    return load_raw_table(spark, path).select("id", "groupe_id", "texte")


def _ads(spark, folder) -> DataFrame:
    return valid_ads(route(_answers(spark, folder))).select(
        F.col("event_id").cast("string").alias("id"), "type_bien", "quartier_zone", "superficie_m2", "prix_fcfa", "statut_document",
        "contacts_whatsapp", "mots_cles_pertinents", "resume_court", F.lit('un "mot", deux ').alias("texte_nettoye"),
    )


def _read_csv(spark, path, columns) -> DataFrame:
    """Part files as text; an empty cell is ''."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    cells = spark.read.schema(schema).csv(
        path, header=True, enforceSchema=True, escape='"', multiLine=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return cells.na.fill("")


def export_ads_csv(spark, folder):
    path = work_folder(spark, "export")
    export_ads(_ads(spark, folder), path, contacts="raw")
    return _read_csv(spark, path, AD_COLUMNS).select("id", "type_bien", "superficie_m2", "prix_fcfa", "contacts_whatsapp", "texte_nettoye", "url")


def export_masked_csv(spark, folder):
    path = work_folder(spark, "export")
    export_ads(_ads(spark, folder), path)
    return _read_csv(spark, path, AD_COLUMNS).select("id", "contacts_whatsapp")


def export_master_csv(spark, folder):
    """Two upserts into the master, then its consultation copy."""
    path = work_folder(spark, "maitre")
    ads = _ads(spark, folder)
    upsert_master(ads.filter("type_bien = 'villa'"), f"{path}/t", NOW, ["id"])
    upsert_master(ads.filter("prix_fcfa < 50 OR prix_fcfa > 5000000000 OR prix_fcfa IS NULL OR type_bien <> 'villa'"), f"{path}/t", LATER, ["id"])
    export_master(load_master(spark, f"{path}/t"), f"{path}/vue")
    return _read_csv(spark, f"{path}/vue", MASTER.fieldNames()).select("id", "date_incertaine", "prix_fcfa", "premiere_collecte", "derniere_maj")


def rejects_audit(spark, folder):
    path = work_folder(spark, "rejets")
    level1 = rejects(tag_posts(documents(spark, folder), TEST_RULES)).select(F.col("id").cast("string").alias("id"), "motif_rejet", "texte")
    level2 = invalid_posts(route(_answers(spark, folder))).select(F.col("event_id").cast("string").alias("id"), "motif_rejet", "type_bien")
    write_rejects(level1, level2, path, contacts="raw")
    back = spark.read.schema("id STRING, texte STRING, type_bien STRING, motif_rejet STRING").json(path)
    return back.select("id", "motif_rejet", F.md5("texte").alias("texte_md5"), "type_bien")


def rules_only_candidates(spark, folder):
    path = work_folder(spark, "candidats")
    posts = documents(spark, folder).withColumn("id", F.lpad(F.col("id").cast("string"), 12, "0"))
    rules_only_run(posts, path, ["id"], TEST_RULES, contacts="raw")
    return _read_csv(spark, f"{path}/candidats_sans_llm", CANDIDATE_COLUMNS).select("id", "texte_nettoye")


def full_run_summary(spark, folder):
    path = work_folder(spark, "run")
    posts = documents(spark, folder).withColumn("id", F.lpad(F.col("id").cast("string"), 12, "0"))
    places = Places(f"{path}/maitre", f"{path}/runs", f"{path}/sorties", f"{path}/vue")
    summary = full_run(spark, posts, places, NOW, ["id"], rules=TEST_RULES)
    master = load_master(spark, places.master).agg(F.count("*").alias("n"))
    logged = spark.read.parquet(places.runs).agg(F.sum("nb_valides").alias("n"))
    return summary.select(
        "nb_posts_bruts", "nb_candidats", "nb_valides", master.select("n").scalar().alias("nb_maitre"),
        logged.select("n").scalar().alias("nb_journal"),
    )


def _collected(spark, folder) -> str:
    """Pages as group pages and turns as feed responses, far down the feed; a seventh of the pages is blocked."""
    path = work_folder(spark, "collecte")
    lang = F.regexp_extract("html", '<html lang="([a-z]+)"', 1)
    address = F.when(F.col("page_id") % 7 == 0, F.concat("url", F.lit("/checkpoint/"))).otherwise(F.col("url")).alias("url")
    pages = _pages_with_records(spark, folder).select(lang.alias("groupe_id"), address, "html")
    roles = F.when(F.col("groupe_id") == "user", "en").when(F.col("groupe_id") == "assistant", "fr").otherwise("de")
    responses = _responses(spark, folder).select(
        roles.alias("groupe_id"), (F.col("turn") * 10_000).alias("step"), F.col("conv_id").alias("response_pos"), "body"
    )
    groups = documents(spark, folder).select(F.col("lang").alias("id"), F.upper("lang").alias("nom")).distinct()
    cutoff = datetime(2023, 1, 1, tzinfo=timezone.utc)
    collect_posts(pages, responses, groups, f"{path}/vus", f"{path}/reperes", f"{path}/brut", cutoff, NOW, f"{path}/ecartees")
    return path


def collect_posts_query(spark, folder):
    """Everything is new on the first visit."""
    raw = load_raw_table(spark, f"{_collected(spark, folder)}/brut")
    return raw.select("id", "groupe_id", "groupe_nom", "url", "texte", "date_publication")


def left_out_pages(spark, folder):
    return spark.read.parquet(f"{_collected(spark, folder)}/ecartees").select("groupe_id", "url", "statut")


def full_run_ads(spark, folder):
    """The exported ads of a whole run, row by row."""
    path = work_folder(spark, "run")
    posts = documents(spark, folder).withColumn("id", F.lpad(F.col("id").cast("string"), 12, "0"))
    full_run(spark, posts, Places(f"{path}/maitre", f"{path}/runs", f"{path}/sorties", f"{path}/vue"), NOW, ["id"], rules=TEST_RULES, contacts="raw")
    return _read_csv(spark, f"{path}/sorties/annonces", AD_COLUMNS).select("id", "texte_nettoye")


def full_run_copies(spark, folder):
    """The text copies that a whole run lists, with the post that stands for each."""
    path = work_folder(spark, "run")
    posts = documents(spark, folder).withColumn("id", F.lpad(F.col("id").cast("string"), 12, "0"))
    full_run(spark, posts, Places(f"{path}/maitre", f"{path}/runs", f"{path}/sorties", f"{path}/vue"), NOW, ["id"], rules=TEST_RULES)
    return spark.read.schema("id STRING, id_garde STRING").json(f"{path}/sorties/doublons")


def _in_parts(df: DataFrame, path: str, time: str = "ts") -> None:
    """Write rows as files that arrive in three steps: before, within and after ten days of January."""
    at = F.col(time)
    first, second = F.lit("2024-01-11").cast("timestamp"), F.lit("2024-01-21").cast("timestamp")
    for part in (df.filter(at < first), df.filter((at >= first) & (at < second)), df.filter(at >= second)):
        part.repartition(2).write.mode("append").parquet(path)


def _event_rows(spark, folder) -> DataFrame:
    return events(spark, folder).select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("id"), F.col("event_type").alias("groupe_nom"),
        (F.col("value") * 100).cast("bigint").alias("prix_fcfa"), "ts", F.col("event_id").alias("_pos"),
    )


def stream_dedup(spark, folder):
    """Ids that repeat within and across batches; one type comes without a time, one a year late."""
    path = work_folder(spark, "flux")
    kind = F.col("groupe_nom")
    shown = F.when(kind == "signup", F.col("ts") - F.expr("INTERVAL 400 DAYS")).when(kind != "error", F.col("ts"))
    rows = _event_rows(spark, folder).withColumn("date_publication", shown)
    _in_parts(rows, f"{path}/entree")
    first_post_stream(read_new_files(spark, f"{path}/entree", rows.schema, 2), f"{path}/sortie", f"{path}/point").awaitTermination()
    kept = journal.read(spark, f"{path}/sortie", rows.schema)
    return kept.select("id", "groupe_nom", "prix_fcfa", "_pos", F.col("date_publication").isNull().cast("int").alias("sans_date"))


def stream_expiry(spark, folder):
    """Ids that come again in later batches: forgotten ten days after their first sighting, except where a row has no time."""
    path = work_folder(spark, "flux")
    rows = _event_rows(spark, folder).withColumn("vu", F.when(F.col("groupe_nom") != "error", F.col("ts")))
    _in_parts(rows, f"{path}/entree")
    stream = read_new_files(spark, f"{path}/entree", rows.schema, 2)
    first_post_stream(stream, f"{path}/sortie", f"{path}/point", seen_at="vu", retention=timedelta(days=10)).awaitTermination()
    return journal.read(spark, f"{path}/sortie", rows.schema).select("id", "groupe_nom", "prix_fcfa", "_pos")


def stream_restart(spark, folder):
    """Posts and master after a stop and go: the second query has a new checkpoint on the old tables and reads everything again."""
    path = work_folder(spark, "flux")
    rows = _event_rows(spark, folder)
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    rows.filter(early).repartition(2).write.parquet(f"{path}/entree")
    for checkpoint, more in (("a", rows.filter(~early)), ("a", None), ("b", None)):
        stream = read_new_files(spark, f"{path}/entree", rows.schema, 2)
        first_post_stream(stream, f"{path}/posts", f"{path}/p{checkpoint}").awaitTermination()
        upsert_stream(stream, f"{path}/maitre", f"{path}/m{checkpoint}", NOW if checkpoint == "a" else LATER).awaitTermination()
        if more is not None:
            more.repartition(2).write.mode("append").parquet(f"{path}/entree")
    posts = journal.read(spark, f"{path}/posts", rows.schema).select("id", F.col("prix_fcfa").alias("premier_prix"))
    master = load_master(spark, f"{path}/maitre").select("id", "prix_fcfa", *[F.unix_micros(c).alias(f"{c}_us") for c in ("premiere_collecte", "derniere_maj")])
    return posts.join(master, "id", "full")


def master_lots(spark, folder):
    """Ten interleaved batches, one a day; the lots of the first ones are merged on the way."""
    path = work_folder(spark, "maitre")
    rows = _event_rows(spark, folder).withColumn("_lot", F.pmod("_pos", F.lit(10)))
    for n in range(10):
        upsert_master(rows.filter(F.col("_lot") == n), path, NOW + timedelta(days=n), ["_pos"])
    micros = [F.unix_micros(c).alias(f"{c}_us") for c in ("premiere_collecte", "derniere_maj")]
    return load_master(spark, path).select("id", "groupe_nom", "prix_fcfa", *micros)


def stream_upsert(spark, folder):
    """Three batches into the master; the query is started again and finds nothing to do twice."""
    path = work_folder(spark, "flux")
    rows = _event_rows(spark, folder)
    _in_parts(rows, f"{path}/entree")
    for _ in range(2):
        upsert_stream(read_new_files(spark, f"{path}/entree", rows.schema, 2), f"{path}/maitre", f"{path}/point", NOW).awaitTermination()
    return load_master(spark, f"{path}/maitre").select("id", "groupe_nom", "prix_fcfa", F.unix_micros("derniere_maj").alias("maj_us"))


def stream_scores(spark, folder):
    """The run log arrives in three parts; the scores are carried from part to part."""
    path = work_folder(spark, "flux")
    runs = health_runs(spark, folder)
    _in_parts(runs, f"{path}/entree")
    score_stream(read_new_files(spark, f"{path}/entree", runs.schema, 2), f"{path}/scores", f"{path}/point").awaitTermination()
    return load_health(spark, f"{path}/scores").select(
        "source", F.round("niveau_confiance", 9).alias("niveau_confiance"), "runs_propres_consecutifs", "cooldown_multiplicateur"
    )


QUERIES = {
    "active_groups": active_groups_query,
    "first_groups": first_groups,
    "raw_post_lines": raw_post_lines,
    "raw_line_issues": raw_line_issues,
    "raw_posts_merge": raw_posts_merge,
    "raw_files_load": raw_files_load,
    "raw_files_split": raw_files_split,
    "raw_file_issues": raw_file_issues,
    "raw_append_read": raw_append_read,
    "export_ads_csv": export_ads_csv,
    "export_masked_csv": export_masked_csv,
    "export_master_csv": export_master_csv,
    "rejects_audit": rejects_audit,
    "rules_only_candidates": rules_only_candidates,
    "full_run_summary": full_run_summary,
    "full_run_ads": full_run_ads,
    "full_run_copies": full_run_copies,
    "collect_posts": collect_posts_query,
    "left_out_pages": left_out_pages,
    "stream_dedup": stream_dedup,
    "stream_expiry": stream_expiry,
    "stream_restart": stream_restart,
    "master_lots": master_lots,
    "stream_upsert": stream_upsert,
    "stream_scores": stream_scores,
}

_LINES_SQL = """SELECT lpad(doc_id::VARCHAR, 12, '0') AS _file, source, lang, unnest(lines) AS texte, generate_subscripts(lines, 1) - 1 AS _pos
    FROM (SELECT *, string_split(text, chr(10)) AS lines FROM documents)"""
_VALID_SQL = f"""SELECT * FROM ({_KEPT}) WHERE {sql_words('t', 'est|ist|with')} OR {sql_search('t', '[0-9]{4,}')}"""
_ROLE_GROUP = "CASE role WHEN 'user' THEN 'en' WHEN 'assistant' THEN 'fr' ELSE 'de' END"
_ADS_SQL = f"""SELECT event_id::VARCHAR AS id, kind, CASE kind WHEN 'purchase' THEN 'ferme' ELSE 'villa' END AS type_bien,
        aire::BIGINT::VARCHAR AS superficie_m2, prix, k FROM ({_ROUTED_SQL}) WHERE issue = 'valide'"""

_ARRAYS_SQL = """SELECT source || '-' || (doc_id % 200) AS id, source AS groupe_id, md5(arg_max(text, doc_id) || '}, {"' || chr(92)) AS texte_md5, min(n) - 1 AS _pos
    FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) GROUP BY source, doc_id % 200"""

ORACLE = {
    "raw_files_load": _ARRAYS_SQL,
    "raw_files_split": _ARRAYS_SQL,
    "stream_scores": f"""{HEALTH_SQL} SELECT source, round(conf, 9) AS niveau_confiance, serie AS runs_propres_consecutifs,
            mult AS cooldown_multiplicateur FROM fold QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC) = 1""",
    "active_groups": """SELECT s_suppkey::VARCHAR AS id, s_name || ', "suite"' AS nom, 'https://exemple.test/groups' AS url, 1 AS actif
        FROM supplier WHERE s_acctbal < 5000 OR (s_acctbal >= 8000 AND s_acctbal <= 9000)""",
    "first_groups": """SELECT s_suppkey::VARCHAR AS id, s_name || ', "suite"' AS nom FROM supplier
        WHERE s_acctbal < 5000 OR (s_acctbal >= 8000 AND s_acctbal <= 9000) ORDER BY s_suppkey LIMIT 7""",
    "raw_post_lines": """SELECT source || '-' || (doc_id % 100) AS id, source AS groupe_id, arg_max(text, doc_id) AS texte
        FROM documents WHERE lang NOT IN ('es', 'de') GROUP BY source, doc_id % 100""",
    "raw_line_issues": """SELECT (lang = 'es')::INT AS lisible, md5(CASE WHEN lang = 'de' THEN left(p, length(p) - 1) ELSE p END) AS ligne_md5
        FROM (SELECT lang, '{' || CASE WHEN lang = 'es' THEN '' ELSE '"id":"' || source || '-' || (doc_id % 100) || '",' END || '"groupe_id":"' || source
            || '","texte":' || to_json(text) || ',"_pos":' || doc_id || '}' AS p FROM documents WHERE lang IN ('es', 'de'))""",
    "left_out_pages": """SELECT regexp_extract(html, '<html lang="([a-z]+)"', 1) AS groupe_id, url || '/checkpoint/' AS url, 'blocked' AS statut
        FROM pages WHERE page_id % 7 = 0""",
    "full_run_ads": f"SELECT lpad(id::VARCHAR, 12, '0') AS id, t AS texte_nettoye FROM ({_VALID_SQL})",
    "full_run_copies": f"""SELECT lpad(id::VARCHAR, 12, '0') AS id, lpad(premier::VARCHAR, 12, '0') AS id_garde
        FROM (SELECT id, t, min(id) OVER (PARTITION BY t) AS premier FROM ({TAGGED}) WHERE motif IS NULL AND t <> '') WHERE id <> premier""",
    "raw_posts_merge": f"""SELECT id, arg_max(texte, _file || lpad(_pos::VARCHAR, 9, '0')) AS texte, min(_file) AS _file,
            arg_min(_pos, _file || lpad(_pos::VARCHAR, 9, '0'))::BIGINT AS _pos
        FROM (SELECT *, source || '-' || _pos AS id FROM ({_LINES_SQL})) WHERE lang <> 'de' AND (lang <> 'es' OR _pos > 0) GROUP BY id""",
    "raw_file_issues": """SELECT lpad(doc_id::VARCHAR, 12, '0') AS _file, (lang <> 'de')::INT AS lisible, (lang = 'es')::INT AS sans_id
        FROM documents WHERE lang IN ('de', 'es')""",
    "raw_append_read": """SELECT conv_id::VARCHAR AS id,
            arg_max(role, CASE role WHEN 'assistant' THEN 2000000 WHEN 'user' THEN 1000000 ELSE 0 END + turn) AS groupe_id,
            arg_max(text, CASE role WHEN 'assistant' THEN 2000000 WHEN 'user' THEN 1000000 ELSE 0 END + turn) AS texte
        FROM conversations GROUP BY 1""",
    "export_ads_csv": f"""SELECT id, type_bien, coalesce(superficie_m2, '') AS superficie_m2, prix::VARCHAR AS prix_fcfa,
            CASE WHEN kind = 'click' THEN '70 ' || k || '; x' ELSE '' END AS contacts_whatsapp, 'un "mot", deux ' AS texte_nettoye, '' AS url
        FROM ({_ADS_SQL})""",
    # All digits but the last two are hidden.
    "export_masked_csv": f"""SELECT id, CASE WHEN kind <> 'click' THEN '' WHEN length(k) = 1 THEN '*0 ' || k || '; x'
            ELSE '** ' || k || '; x' END AS contacts_whatsapp FROM ({_ADS_SQL})""",
    "export_master_csv": f"""SELECT id, 'False' AS date_incertaine, prix::VARCHAR AS prix_fcfa,
            CASE WHEN type_bien = 'villa' THEN '2024-01-31' ELSE '2024-02-01' END || 'T00:00:00+00:00' AS premiere_collecte,
            CASE WHEN type_bien = 'villa' AND prix >= 50 AND prix <= 5000000000 THEN '2024-01-31' ELSE '2024-02-01' END || 'T00:00:00+00:00' AS derniere_maj
        FROM ({_ADS_SQL})""",
    "rejects_audit": f"""SELECT t.id::VARCHAR AS id, motif AS motif_rejet, md5(d.text) AS texte_md5, NULL::VARCHAR AS type_bien
        FROM ({TAGGED}) t JOIN documents d ON d.doc_id = t.id WHERE motif IS NOT NULL
        UNION ALL SELECT event_id::VARCHAR, issue, NULL, CASE WHEN ok THEN json_extract_string(jj, '$.type_bien') END FROM ({_ROUTED_SQL}) WHERE issue <> 'valide'""",
    "rules_only_candidates": f"SELECT lpad(id::VARCHAR, 12, '0') AS id, t AS texte_nettoye FROM ({_KEPT})",
    "full_run_summary": f"""SELECT (SELECT count(*) FROM documents) AS nb_posts_bruts, (SELECT count(*) FROM ({_KEPT})) AS nb_candidats,
            n AS nb_valides, n AS nb_maitre, n AS nb_journal FROM (SELECT count(*) AS n FROM ({_VALID_SQL}))""",
    "collect_posts": f"""WITH p AS (SELECT *, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS g FROM pages WHERE page_id % 7 <> 0)
        SELECT 'a' || page_id AS id, g AS groupe_id, upper(g) AS groupe_nom, 'https://exemple.test/posts/' || page_id AS url,
            replace(html, '<', ' ') AS texte, strftime(to_timestamp({BASE_TIME} + page_id) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S') || '+00:00' AS date_publication FROM p
        UNION ALL SELECT 'r' || page_id, g, upper(g), NULL, url, NULL FROM p
        UNION ALL SELECT CASE role WHEN 'user' THEN 'u' ELSE 'v' END || conv_id || '-' || turn, {_ROLE_GROUP}, upper({_ROLE_GROUP}), NULL, text, NULL FROM conversations
        UNION ALL SELECT 'w' || conv_id || '-' || turn, {_ROLE_GROUP}, upper({_ROLE_GROUP}), NULL, role, NULL FROM conversations WHERE role <> 'user'""",
    "stream_dedup": """SELECT user_id || '-' || event_type AS id, event_type AS groupe_nom, trunc(arg_min(value, event_id) * 100)::BIGINT AS prix_fcfa,
            min(event_id) AS _pos, (event_type = 'error')::INT AS sans_date FROM events GROUP BY user_id, event_type""",
    # The first row of each third of the month; a third's row stays if nothing was kept or that is ten days back.
    "stream_expiry": """WITH RECURSIVE e AS (SELECT user_id || '-' || event_type AS id, event_type, value, event_id, ts,
            CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS part FROM events),
        f AS (SELECT id, part, min(event_id) AS event_id, arg_min(event_type, event_id) AS kind, arg_min(value, event_id) AS value,
            arg_min(ts, event_id) AS ts, row_number() OVER (PARTITION BY id ORDER BY part) AS n FROM e GROUP BY id, part),
        r AS (SELECT id, n, ts AS kept, true AS stays FROM f WHERE n = 1
            UNION ALL SELECT f.id, f.n, CASE WHEN x THEN f.ts ELSE r.kept END, x FROM (
                SELECT f.*, r.kept, f.kind <> 'error' AND f.ts > r.kept + INTERVAL 10 DAY AS x FROM f JOIN r ON r.id = f.id AND f.n = r.n + 1) f JOIN r ON r.id = f.id AND f.n = r.n + 1)
        SELECT id, kind AS groupe_nom, trunc(value * 100)::BIGINT AS prix_fcfa, event_id AS _pos FROM r JOIN f USING (id, n) WHERE stays""",
    "stream_restart": """SELECT user_id || '-' || event_type AS id,
            trunc(coalesce(arg_min(value, event_id) FILTER (WHERE ts < TIMESTAMP '2024-01-16'), arg_min(value, event_id)) * 100)::BIGINT AS premier_prix,
            trunc(arg_max(value, (ts >= TIMESTAMP '2024-01-16')::INT * 1000000000 + event_id) * 100)::BIGINT AS prix_fcfa,
            epoch_us(TIMESTAMP '2024-01-31') AS premiere_collecte_us, epoch_us(TIMESTAMP '2024-02-01') AS derniere_maj_us FROM events GROUP BY 1""",
    "master_lots": """SELECT user_id || '-' || event_type AS id, event_type AS groupe_nom,
            trunc(arg_max(value, (event_id % 10) * 1000000000 + event_id) * 100)::BIGINT AS prix_fcfa,
            epoch_us(TIMESTAMP '2024-01-31') + min(event_id % 10) * 86400000000 AS premiere_collecte_us,
            epoch_us(TIMESTAMP '2024-01-31') + max(event_id % 10) * 86400000000 AS derniere_maj_us FROM events GROUP BY 1, 2""",
    "stream_upsert": """SELECT user_id || '-' || event_type AS id, event_type AS groupe_nom,
            trunc(arg_max(value, event_id) * 100)::BIGINT AS prix_fcfa, epoch_us(TIMESTAMP '2024-01-31') AS maj_us FROM events GROUP BY 1, 2""",
}

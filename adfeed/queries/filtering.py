"""Cleaning, rules, deduplication and counts on the documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeed.functions.capture import capture_status
from adfeed.functions.checks import non_negative, unknown_value
from adfeed.functions.rules import rental_tag
from adfeed.functions.text import clean_text, is_permalink, mask_credentials
from adfeed.functions.vocab import canonicalise, canonicalise_join
from adfeed.operators.dedup import dedup_first, dedup_last, dedup_text, text_duplicates
from adfeed.operators.filtering import candidates, funnel, reject_breakdown, rejects, tag_posts
from adfeed.queries.base import (
    TEST_RULES, by_language, documents, sql_by_language, sql_clean, sql_land_reason, sql_strip,
    sql_test_reason, sql_words, table,
)
from adfeed.session import spread, with_computed

# White space that is not a blank: no-break space, file separator, em space.
NBSP, FILE_SEPARATOR, EM_SPACE = chr(0xA0), chr(0x1C), chr(0x2003)
ODD_SPACES = NBSP + FILE_SEPARATOR + EM_SPACE

# Sentences that send the invented texts through each branch of the land rules.
LAND_PHRASES = {
    "fr": " Parcelle de 600m2 à vendre, prix : 15 000 000 FCFA négociable",
    "en": " Je recherche un terrain à Saaba",
    "de": " Cliquez ici : parcelle à vendre",
    "es": " Je cherche une parcelle, prix 15000",
}
RENTAL_PHRASES = {"fr": " Maison à LOUER", "de": " louera", "es": " bail, loyer"}
SEGMENTS = ["Building", "Automobile", "Machinery", "Household"]


def _tagged(spark: SparkSession, folder: str) -> DataFrame:
    return tag_posts(documents(spark, folder), TEST_RULES)


def clean_text_query(spark, folder):
    texts = F.concat("texte", F.lit(" https://exemple.test/p?"), "groupe_id", F.lit(ODD_SPACES + " fin " + NBSP))
    return spread(documents(spark, folder)).select("id", clean_text(texts).alias("texte_nettoye"))


def filter_decision(spark, folder):
    return _tagged(spark, folder).select("id", F.coalesce("motif_rejet", F.lit("candidat")).alias("decision"))


def land_rules_decision(spark, folder):
    posts = documents(spark, folder).withColumn("texte", F.concat("texte", by_language(F.col("lang"), LAND_PHRASES)))
    return tag_posts(posts).select("id", F.coalesce("motif_rejet", F.lit("candidat")).alias("decision"))


def candidate_posts(spark, folder):
    return candidates(_tagged(spark, folder), ["id"]).select("id", "groupe_id", "texte_nettoye")


def candidate_funnel(spark, folder):
    return funnel(_tagged(spark, folder), ["groupe_id"], ["id"])


def reject_breakdown_query(spark, folder):
    return reject_breakdown(rejects(_tagged(spark, folder)), ["groupe_id"])


def _cleaned(spark, folder):
    return with_computed(spread(documents(spark, folder)), "texte_nettoye", clean_text(F.col("texte")))


def dedup_text_first(spark, folder):
    return dedup_text(_cleaned(spark, folder), ["id"]).select("id", "groupe_id")


def text_duplicates_query(spark, folder):
    return text_duplicates(_cleaned(spark, folder), ["id"])


def dedup_text_blank(spark, folder):
    """Blank texts are no copies of each other: Spanish ones lose their words, a part of the French ones shares one text."""
    short = F.when(F.col("lang") == "es", F.lit(ODD_SPACES)).when((F.col("lang") == "fr") & (F.col("id") % 3 == 0), F.lit("même")).otherwise(F.col("texte"))
    cleaned = with_computed(documents(spark, folder).withColumn("texte", short), "texte_nettoye", clean_text(F.col("texte")))
    return dedup_text(cleaned, ["id"]).select("id", "lang")


def dedup_id_last(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return dedup_last(turns, "conv_id", ["turn"])


def dedup_id_first(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return dedup_first(turns, ["conv_id", "role"], ["turn"])


def rental_tag_query(spark, folder):
    posts = documents(spark, folder)
    texts = F.concat("texte", by_language(F.col("lang"), RENTAL_PHRASES))
    return posts.select(
        "id", rental_tag(texts).cast("int").alias("location"), rental_tag(texts, TEST_RULES).cast("int").alias("location_test")
    )


def page_status(spark, folder):
    """Signs of a bad capture, added to the pages by the language in their address."""
    pages = table(spark, folder, "pages")
    signs = (
        F.when(F.col("url").contains("/de/"), "<p>Confirmez votre Identité</p>")
        .when(F.col("url").contains("/es/"), '<script>{"USER_ID":"0"}</script>')
        .when(F.col("url").contains("/fr/"), '<form class="x" id="login_form"><input type=password name="pass"></form>')
        .otherwise('<script>{"USER_ID":"61"}</script><input name="passage">')
    )
    url = F.regexp_replace("url", r"\?page=", "/Checkpoint?page=")
    return pages.select("page_id", capture_status(url, F.concat("html", signs)).alias("statut"))


def page_permalink(spark, folder):
    url = F.regexp_replace("url", "/en/", "/posts/")
    return table(spark, folder, "pages").select("page_id", is_permalink(url).cast("int").alias("permalien"))


def mask_credentials_query(spark, folder):
    texts = F.concat(F.lit("postgresql://u"), "groupe_id", F.lit(":p:ss/"), F.col("id").cast("string"), F.lit("@hote/b "), "texte")
    return documents(spark, folder).select("id", mask_credentials(texts).alias("texte"))


def _segment():
    balance = F.col("c_acctbal")
    return (
        F.when(balance < 0, F.lower("c_mktsegment"))
        .when(balance < 500, F.lit(""))
        .when(balance < 1000, F.lit(" " + NBSP))
        .otherwise(F.concat(F.lit(NBSP + " "), F.initcap("c_mktsegment"), F.lit(FILE_SEPARATOR)))
    )


def canonical_vocab(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", canonicalise(_segment(), SEGMENTS).alias("segment"))


def canonical_vocab_join(spark, folder):
    """The vocabulary as a table: nation names against free spellings of them."""
    names = table(spark, folder, "nation").select(F.initcap("n_name").alias("valeur"))
    typed = table(spark, folder, "customer").select(
        "c_custkey",
        F.concat(F.when(F.col("c_acctbal") < 0, "  nation_").otherwise("NATION "), F.col("c_nationkey").cast("string")).alias("pays"),
    )
    return canonicalise_join(typed, "pays", names)


def typed_checks(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        non_negative(F.col("c_acctbal")).alias("solde"),
        unknown_value(F.col("c_mktsegment"), ["BUILDING", "MACHINERY"]).cast("int").alias("inconnu"),
    )


QUERIES = {
    "clean_text": clean_text_query,
    "filter_decision": filter_decision,
    "land_rules_decision": land_rules_decision,
    "candidate_posts": candidate_posts,
    "candidate_funnel": candidate_funnel,
    "reject_breakdown": reject_breakdown_query,
    "dedup_text_first": dedup_text_first,
    "dedup_text_blank": dedup_text_blank,
    "text_duplicates": text_duplicates_query,
    "dedup_id_last": dedup_id_last,
    "dedup_id_first": dedup_id_first,
    "rental_tag": rental_tag_query,
    "page_status": page_status,
    "page_permalink": page_permalink,
    "mask_credentials": mask_credentials_query,
    "canonical_vocab": canonical_vocab,
    "canonical_vocab_join": canonical_vocab_join,
    "typed_checks": typed_checks,
}

_CLEANED = f"SELECT doc_id AS id, source AS groupe_id, lang, {sql_clean('text')} AS t FROM documents"
TAGGED = f"SELECT *, {sql_test_reason('t')} AS motif FROM ({_CLEANED})"
_KEPT = f"""SELECT * FROM ({TAGGED}) WHERE motif IS NULL
    QUALIFY row_number() OVER (PARTITION BY t ORDER BY id) = 1"""
_LAND = sql_clean("text || " + sql_by_language("lang", LAND_PHRASES))
_SEGMENT_SQL = """CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment) WHEN c_acctbal < 500 THEN ''
    WHEN c_acctbal < 1000 THEN ' ' || chr(160)
    ELSE chr(160) || ' ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || chr(28) END"""

ORACLE = {
    "clean_text": f"""SELECT doc_id AS id, {sql_clean("text || ' https://exemple.test/p?' || source || chr(160) || chr(28) || chr(8195) || ' fin ' || chr(160)")} AS texte_nettoye
        FROM documents""",
    "filter_decision": f"SELECT id, coalesce(motif, 'candidat') AS decision FROM ({TAGGED})",
    "land_rules_decision": f"""SELECT id, coalesce({sql_land_reason('t')}, 'candidat') AS decision
        FROM (SELECT doc_id AS id, {_LAND} AS t FROM documents)""",
    "candidate_posts": f"SELECT id, groupe_id, t AS texte_nettoye FROM ({_KEPT})",
    "candidate_funnel": f"""SELECT a.groupe_id, a.nb_bruts, a.nb_rejetes, coalesce(k.n, 0) AS nb_candidats,
            a.acceptes - coalesce(k.n, 0) AS nb_doublons, 0::BIGINT AS nb_valides,
            (100 * coalesce(k.n, 0)) / greatest(a.nb_bruts, 1) AS pct_candidats
        FROM (SELECT groupe_id, count(*) AS nb_bruts, count(motif) AS nb_rejetes, count(*) - count(motif) AS acceptes
              FROM ({TAGGED}) GROUP BY 1) a
        LEFT JOIN (SELECT groupe_id, count(*) AS n FROM ({_KEPT}) GROUP BY 1) k USING (groupe_id)""",
    "reject_breakdown": f"""SELECT motif AS motif_rejet, groupe_id, count(*) AS nb_rejetes FROM ({TAGGED})
        WHERE motif IS NOT NULL GROUP BY 1, 2""",
    "dedup_text_first": f"""SELECT id, groupe_id FROM ({_CLEANED})
        QUALIFY t = '' OR row_number() OVER (PARTITION BY t ORDER BY id) = 1""",
    "dedup_text_blank": f"""SELECT id, lang FROM (SELECT c.id, d.lang, CASE WHEN d.lang = 'es' THEN ''
            WHEN d.lang = 'fr' AND c.id % 3 = 0 THEN 'même' ELSE c.t END AS t FROM ({_CLEANED}) c JOIN documents d ON d.doc_id = c.id)
        QUALIFY t = '' OR row_number() OVER (PARTITION BY t ORDER BY id) = 1""",
    "text_duplicates": f"""SELECT id, premier AS id_garde FROM
        (SELECT id, t, min(id) OVER (PARTITION BY t) AS premier FROM ({_CLEANED})) WHERE t <> '' AND id <> premier""",
    "dedup_id_last": """SELECT conv_id, min(turn) AS turn, arg_max(role, turn) AS role, arg_max(text, turn) AS text
        FROM conversations GROUP BY 1""",
    "dedup_id_first": """SELECT conv_id, min(turn) AS turn, role, arg_min(text, turn) AS text
        FROM conversations GROUP BY conv_id, role""",
    "rental_tag": f"""SELECT id, {sql_words('t', 'location|louer|loyer|bail')}::INT AS location,
            {sql_words('t', 'bien|the' + chr(92) + 's+of|und')}::INT AS location_test
        FROM (SELECT doc_id AS id, text || {sql_by_language('lang', RENTAL_PHRASES)} AS t FROM documents)""",
    "page_status": """SELECT page_id, CASE WHEN contains(url, '?page=') THEN 'blocked' WHEN contains(url, '/de/') THEN 'blocked'
            WHEN contains(url, '/es/') OR contains(url, '/fr/') THEN 'session_expired' ELSE 'ok' END AS statut
        FROM pages""",
    "page_permalink": "SELECT page_id, contains(url, '/en/')::INT AS permalien FROM pages",
    "mask_credentials": """SELECT doc_id AS id, regexp_replace('postgresql://u' || source || ':p:ss/' || doc_id || '@hote/b ' || text,
            '://([^:/@]+):([^@]+)@', '://\\1:***@', 'g') AS texte FROM documents""",
    "canonical_vocab": f"""SELECT c_custkey, CASE WHEN s <> '' THEN CASE lower({sql_strip('s')}) WHEN 'building' THEN 'Building'
            WHEN 'automobile' THEN 'Automobile' WHEN 'machinery' THEN 'Machinery' WHEN 'household' THEN 'Household'
            ELSE {sql_strip('s')} END END AS segment
        FROM (SELECT c_custkey, {_SEGMENT_SQL} AS s FROM customer)""",
    "canonical_vocab_join": """SELECT c_custkey, CASE WHEN c_acctbal < 0 AND n_name IS NOT NULL
                THEN upper(n_name[1]) || lower(n_name[2:])
            WHEN c_acctbal < 0 THEN 'nation_' || c_nationkey ELSE 'NATION ' || c_nationkey END AS pays
        FROM customer LEFT JOIN nation ON lower(n_name) = 'nation_' || c_nationkey""",
    "typed_checks": """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS solde,
            (c_mktsegment NOT IN ('BUILDING', 'MACHINERY'))::INT AS inconnu FROM customer""",
}

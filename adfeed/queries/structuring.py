"""Extraction, validation and routing of structured fields."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from adfeed.functions.extract import area_m2, contacts, first_named, keywords, price
from adfeed.functions.model_output import validate_output
from adfeed.functions.text import clean_text
from adfeed.operators.structure import Permanent, route, structure
from adfeed.queries.base import TEST_RULES, by_language, documents, events, sql_by_language, sql_clean
from adfeed.session import spread, with_computed

OFFERS = {
    "fr": " Villa de 2,5 ha à 15 000 000 F CFA, Patte d'oie, titre foncier, tel 70 12 34 56",
    "en": " Parcelle 600m2 ou 700 m², 5.000.000 fcfa ou 7000000 CFA, +226 76-54-32-10",
    "de": " ferme de 3 hectares, 250000 CFA, 250.000 fcfa, karpala",
    "es": " 12 habitants, attestation d'attribution, APFR",
}


def _offers(spark, folder):
    posts = spread(documents(spark, folder))
    return with_computed(
        posts.select("id", "lang", "texte"), "t", clean_text(F.concat("texte", by_language(F.col("lang"), OFFERS)))
    )


def contacts_extract(spark, folder):
    return _offers(spark, folder).select("id", F.array_join(contacts(F.col("t")), "|").alias("contacts"))


def amounts_extract(spark, folder):
    text = F.col("t")
    return _offers(spark, folder).select("id", area_m2(text).alias("superficie_m2"), price(text).alias("prix_fcfa"))


def vocabulary_extract(spark, folder):
    text = F.col("t")
    zones, statuses = ["Patte d'Oie", "Karpala"], ["Attestation", "Attestation d'attribution", "Titre foncier"]
    return _offers(spark, folder).select(
        "id", first_named(text, zones).alias("zone"), first_named(text, statuses).alias("statut"),
        F.array_join(F.array_sort(keywords(text, TEST_RULES)), "|").alias("mots"),
    )


TAILS = ["", '} {"x": 1}', "} junk }", "}]", "} \n\t ", "},{}"]


# Answers built from events: one shape per event type, with values from the row.
def _answers(spark, folder):
    k = F.get_json_object("props", "$.k")
    value = F.col("value").cast("decimal(18,2)").cast("string")

    def answer(*parts):
        return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])

    kind = F.col("event_type")
    # What follows a whole answer, or an answer that is cut short.
    tail = F.element_at(F.array(*[F.lit(t) for t in TAILS]), (F.col("event_id") % len(TAILS) + 1).cast("int"))
    text = (
        F.when(kind == "click", answer('{"est_une_annonce_valide": true, "type_bien": "villa", "superficie_m2": ', k,
                                       ', "prix_fcfa": ', F.col("event_id").cast("string"),
                                       '000000, "quartier_zone": " KARPALA ", "contacts_whatsapp": ["70 ', k, '", "x"], "autre": 1, '
                                       '"mots_cles_pertinents": ["lot", "n', k, '"], "resume_court": " résumé ', k, ' "}'))
        .when(kind == "view", answer('{"est_une_annonce_valide": false, "type_bien": "chateau", "prix_fcfa": -', k,
                                     ', "superficie_m2": ', k, '.0, "statut_document": "puh", "contacts_whatsapp": []}'))
        .when(kind == "signup", answer('{"est_une_annonce_valide": "Oui", "type_bien": "villa", "prix_fcfa": ', k, '}'))
        .when(kind == "purchase", answer('{"est_une_annonce_valide": "yes", "type_bien": "ferme", "prix_fcfa": "', k,
                                         '", "superficie_m2": ', value, ', "quartier_zone": null}'))
        .otherwise(answer('{"est_une_annonce_valide": true, "type_bien": "villa", "prix_fcfa": ', k, tail))
    )
    return spread(events(spark, folder)).select("event_id", text.alias("sortie_modele"))


def validate_output_query(spark, folder):
    read = with_computed(_answers(spark, folder), "s", validate_output(F.col("sortie_modele")))
    return read.select(
        "event_id", F.col("s").isNotNull().cast("int").alias("accepte"),
        F.col("s.est_une_annonce_valide").cast("int").alias("valide"), "s.type_bien", "s.superficie_m2", "s.prix_fcfa",
        F.array_join("s.contacts_whatsapp", "; ").alias("contacts"), F.array_join("s.mots_cles_pertinents", "; ").alias("mots"), "s.resume_court",
    )


def route_answers(spark, folder):
    routed = route(_answers(spark, folder))
    return routed.select("event_id", F.coalesce("motif_rejet", F.lit("valide")).alias("issue"), "quartier_zone", "statut_document")


def route_counts(spark, folder):
    issue = F.coalesce("motif_rejet", F.lit("valide")).alias("issue")
    return route(_answers(spark, folder)).groupBy(issue).agg(F.count("*").alias("nb"), F.sum("prix_fcfa").alias("prix"))


def length_extractor(text: str) -> str | None:
    """Stand-in for a model: a fixed answer from the text's length."""
    if "copyright" in text:
        return None
    if "###" in text:
        raise Permanent("unreadable")
    size = len(text)
    return json.dumps({
        "est_une_annonce_valide": size % 2 == 0, "type_bien": "parcelle", "superficie_m2": size,
        "prix_fcfa": size * 1000, "resume_court": text[:20],
    })


def structure_answers(spark, folder):
    answered = structure(documents(spark, folder), length_extractor, text="texte", in_flight=16)
    routed = route(answered)
    return routed.select(
        "id", F.coalesce("motif_rejet", F.lit("valide")).alias("issue"), "superficie_m2", "prix_fcfa", "resume_court"
    )


QUERIES = {
    "contacts_extract": contacts_extract,
    "amounts_extract": amounts_extract,
    "vocabulary_extract": vocabulary_extract,
    "validate_output": validate_output_query,
    "route_answers": route_answers,
    "route_counts": route_counts,
    "structure_answers": structure_answers,
}

_OFFERS_SQL = f"SELECT doc_id AS id, {sql_clean('text || ' + sql_by_language('lang', OFFERS))} AS t FROM documents"


def _first_seen(values: str) -> str:
    """Distinct elements of a list in order of appearance."""
    return f"list_filter({values}, lambda x, i: list_position({values}, x) = i)"


_PHONES = r"""list_filter(regexp_extract_all(t, '(?i)\+?[0-9][0-9 ()-]*[0-9](\s*f?\s*cfa)?'),
    lambda p: length(regexp_replace(p, '[^0-9]', '', 'g')) BETWEEN 8 AND 15
      AND NOT (lower(p) LIKE '%a' OR regexp_matches(p, '^[0-9]{1,3}( [0-9]{3})+$')))"""
_AREA = r"(?i)([0-9]+(?:[.,][0-9]+)?)\s*(m2|m²|hectares?|ha)([\pL\pN_]?)"
_PRICE = r"(?i)([0-9]{1,3}(?:[\s.][0-9]{3})+|[0-9]+)\s*(f?\s*cfa)([\pL\pN_]?)"
_AMOUNTS_SQL = f"""
    SELECT id,
        list_distinct(list_transform(list_filter(regexp_extract_all(t, '{_AREA}'), lambda x: regexp_extract(x, '{_AREA}', 3) = ''),
            lambda x: TRY_CAST(replace(regexp_extract(x, '{_AREA}', 1), ',', '.') AS DECIMAL(28, 6))
                * CASE WHEN lower(regexp_extract(x, '{_AREA}', 2)) LIKE 'h%' THEN 10000 ELSE 1 END)) AS aires,
        list_distinct(list_transform(list_filter(regexp_extract_all(t, '{_PRICE}'), lambda x: regexp_extract(x, '{_PRICE}', 3) = ''),
            lambda x: TRY_CAST(regexp_replace(regexp_extract(x, '{_PRICE}', 1), '[^0-9]', '', 'g') AS BIGINT))) AS prix
    FROM ({_OFFERS_SQL})"""
_WORD_LIST = ["avec", "hath", "license", "mit", "para", "pour"]
_MOTS = " || ".join(
    f"CASE WHEN regexp_matches(t, '(?i)(^|[^\\pL\\pN_]){w}([^\\pL\\pN_]|$)') THEN '|{w}' ELSE '' END" for w in _WORD_LIST
)


def _named(phrase: str) -> str:
    quoted = phrase.replace("'", "''")
    return f"regexp_matches(t, '(?i)(^|[^\\pL\\pN_]){quoted}([^\\pL\\pN_]|$)')"


_ANSWERS_SQL = """
    SELECT event_id, k, v, event_type AS kind, CASE event_type
        WHEN 'click' THEN '{"est_une_annonce_valide": true, "type_bien": "villa", "superficie_m2": ' || k || ', "prix_fcfa": '
            || event_id || '000000, "quartier_zone": " KARPALA ", "contacts_whatsapp": ["70 ' || k || '", "x"], "autre": 1, '
            || '"mots_cles_pertinents": ["lot", "n' || k || '"], "resume_court": " résumé ' || k || ' "}'
        WHEN 'view' THEN '{"est_une_annonce_valide": false, "type_bien": "chateau", "prix_fcfa": -' || k
            || ', "superficie_m2": ' || k || '.0, "statut_document": "puh", "contacts_whatsapp": []}'
        WHEN 'signup' THEN '{"est_une_annonce_valide": "Oui", "type_bien": "villa", "prix_fcfa": ' || k || '}'
        WHEN 'purchase' THEN '{"est_une_annonce_valide": "yes", "type_bien": "ferme", "prix_fcfa": "' || k
            || '", "superficie_m2": ' || v || ', "quartier_zone": null}'
        ELSE '{"est_une_annonce_valide": true, "type_bien": "villa", "prix_fcfa": ' || k
            || (['', '} {"x": 1}', '} junk }', '}]', '} ' || chr(10) || chr(9) || ' ', '},{}'])[event_id % 6 + 1] END AS j
    FROM (SELECT *, json_extract_string(props, '$.k') AS k, value::DECIMAL(18, 2) AS v FROM events)"""
# Accepted: a boolean or a boolean word, integers also as integral decimals or digits.
_READ_SQL = f"""
    SELECT *, json_extract_string(jj, '$.est_une_annonce_valide') AS flag,
        CASE WHEN json_type(jj, '$.superficie_m2') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
             THEN json_extract_string(jj, '$.superficie_m2')::DECIMAL(30, 6) END AS aire,
        TRY_CAST(json_extract_string(jj, '$.prix_fcfa') AS BIGINT) AS prix
    FROM (SELECT *, CASE WHEN json_valid(j) THEN j::JSON END AS jj FROM ({_ANSWERS_SQL}))"""
_ACCEPTED_SQL = f"""
    SELECT *, coalesce(jj IS NOT NULL AND lower(flag) IN ('true', 'false', 'yes', 'no')
        AND (aire IS NULL OR aire = floor(aire)), false) AS ok FROM ({_READ_SQL})"""
_ROUTED_SQL = f"""
    SELECT *, CASE WHEN NOT ok THEN 'echec_api_ou_validation' WHEN lower(flag) IN ('false', 'no') THEN 'llm_juge_invalide'
        ELSE 'valide' END AS issue FROM ({_ACCEPTED_SQL})"""

ORACLE = {
    "contacts_extract": f"SELECT id, array_to_string({_first_seen(_PHONES)}, '|') AS contacts FROM ({_OFFERS_SQL})",
    "amounts_extract": f"""SELECT id,
            CASE WHEN len(aires) = 1 AND aires[1] = floor(aires[1]) THEN aires[1]::BIGINT END AS superficie_m2,
            CASE WHEN len(prix) = 1 THEN prix[1] END AS prix_fcfa FROM ({_AMOUNTS_SQL})""",
    "vocabulary_extract": f"""SELECT id,
            CASE WHEN {_named("Patte d'Oie")} THEN 'Patte d''Oie' WHEN {_named('Karpala')} THEN 'Karpala' END AS zone,
            CASE WHEN {_named("Attestation d'attribution")} THEN 'Attestation d''attribution'
                 WHEN {_named('Titre foncier')} THEN 'Titre foncier' WHEN {_named('Attestation')} THEN 'Attestation' END AS statut,
            ltrim({_MOTS}, '|') AS mots
        FROM ({_OFFERS_SQL})""",
    "validate_output": f"""SELECT event_id, ok::INT AS accepte,
            CASE WHEN ok THEN (lower(flag) IN ('true', 'yes'))::INT END AS valide,
            CASE WHEN ok THEN json_extract_string(jj, '$.type_bien') END AS type_bien,
            CASE WHEN ok AND aire >= 0 THEN aire::BIGINT END AS superficie_m2,
            CASE WHEN ok AND prix >= 0 THEN prix END AS prix_fcfa,
            CASE WHEN ok THEN coalesce(array_to_string(json_extract_string(jj, '$.contacts_whatsapp[*]'), '; '), '') END AS contacts,
            CASE WHEN ok THEN coalesce(array_to_string(json_extract_string(jj, '$.mots_cles_pertinents[*]'), '; '), '') END AS mots,
            CASE WHEN ok THEN coalesce(json_extract_string(jj, '$.resume_court'), '') END AS resume_court
        FROM ({_ACCEPTED_SQL})""",
    "route_answers": f"""SELECT event_id, issue, CASE WHEN issue = 'valide' AND kind = 'click' THEN 'Karpala' END AS quartier_zone,
            CASE WHEN ok AND kind = 'view' THEN 'puh' END AS statut_document FROM ({_ROUTED_SQL})""",
    "route_counts": f"""SELECT issue, count(*) AS nb, sum(CASE WHEN ok AND prix >= 0 THEN prix END)::BIGINT AS prix
        FROM ({_ROUTED_SQL}) GROUP BY 1""",
    "structure_answers": """SELECT doc_id AS id,
            CASE WHEN failed THEN 'echec_api_ou_validation' WHEN length(text) % 2 = 1 THEN 'llm_juge_invalide' ELSE 'valide' END AS issue,
            CASE WHEN NOT failed THEN length(text) END AS superficie_m2, CASE WHEN NOT failed THEN length(text) * 1000 END AS prix_fcfa,
            CASE WHEN NOT failed THEN substring(text, 1, 20) END AS resume_court
        FROM (SELECT *, contains(text, 'copyright') OR contains(text, '###') AS failed FROM documents)""",
}

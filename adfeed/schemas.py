"""Explicit schemas of every table; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(), "BOOLEAN": T.BooleanType(), "BIGINT": T.LongType(), "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(), "TIMESTAMP": T.TimestampType(), "ARRAY<STRING>": T.ArrayType(T.StringType()),
}


def _schema(ddl: str) -> T.StructType:
    """A flat schema from "name TYPE, ..."; unlike fromDDL it needs no session."""
    pairs = [column.split() for column in ddl.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# One element of a raw post file, as it is stored.
RAW_POST = _schema(
    "id STRING, groupe_id STRING, groupe_nom STRING, url STRING, texte STRING, "
    "date_publication STRING, date_incertaine BOOLEAN, scrape_le STRING"
)

# Fields a structuring extractor has to return.
STRUCTURED = _schema(
    "est_une_annonce_valide BOOLEAN, type_bien STRING, quartier_zone STRING, "
    "superficie_m2 BIGINT, prix_fcfa BIGINT, statut_document STRING, "
    "contacts_whatsapp ARRAY<STRING>, mots_cles_pertinents ARRAY<STRING>, resume_court STRING"
)

# Column order of the ad and candidate exports.
AD_COLUMNS = [
    "id", "groupe_nom", "url", "date_publication", "date_incertaine",
    "type_bien", "quartier_zone", "superficie_m2", "prix_fcfa", "statut_document",
    "contacts_whatsapp", "mots_cles_pertinents", "resume_court", "texte_nettoye",
]
CANDIDATE_COLUMNS = ["id", "groupe_nom", "url", "texte_nettoye"]

MASTER = _schema(
    "id STRING, groupe_nom STRING, url STRING, date_publication STRING, date_incertaine BOOLEAN, "
    "type_bien STRING, quartier_zone STRING, superficie_m2 BIGINT, prix_fcfa BIGINT, "
    "statut_document STRING, contacts_whatsapp ARRAY<STRING>, mots_cles_pertinents ARRAY<STRING>, "
    "resume_court STRING, texte_nettoye STRING, type_bien_inconnu BOOLEAN, premiere_collecte TIMESTAMP, derniere_maj TIMESTAMP"
)

RUNS = _schema(
    "horodatage TIMESTAMP, mode STRING, nb_posts_bruts BIGINT, nb_candidats BIGINT, nb_valides BIGINT"
)

SEEN = _schema("id STRING, vu_le_raw STRING")
MARKERS = _schema("groupe_id STRING, post_id STRING")
HEALTH = _schema(
    "source STRING, niveau_confiance DOUBLE, runs_propres_consecutifs INT, "
    "cooldown_multiplicateur INT, derniere_maj TIMESTAMP"
)

# One record found in a nested JSON payload.
RECORD = _schema("id STRING, url STRING, texte STRING, creation_time DOUBLE")

"""Shared parts of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeed.functions.rules import RuleSet

# The test texts are invented words, so this rule set stands in for a market:
# every branch of the decision has rows.
TEST_RULES = RuleSet(
    include=r"\b(avec|pour|license|hath|mit|para)\b",
    numeric=r"\d\s*(de|la|the|c)(?=\D|$)",
    request=r"\b(dans|sich|that\s+the)\b",
    override=r"\b(est|ist|with)\b|\d{4,}",
    spam=r"###|\$\$\$|copyright",
    rental=r"\b(bien|the\s+of|und)\b",
)

_NOT_WORD = r"[^\pL\pN_]"
_SPACES = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_NO_SPACES = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in the shape of raw posts; doc_id is the input order."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("groupe_id"), "lang", F.col("text").alias("texte")
    )


def by_language(col: Column, phrases: dict[str, str]) -> Column:
    """A phrase per language, '' for the others."""
    chosen = F.lit("")
    for lang, phrase in phrases.items():
        chosen = F.when(col == lang, F.lit(phrase)).otherwise(chosen)
    return chosen


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_by_language(col: str, phrases: dict[str, str]) -> str:
    cases = " ".join(f"WHEN {sql_text(k)} THEN {sql_text(v)}" for k, v in phrases.items())
    return f"CASE {col} {cases} ELSE '' END"


def sql_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{_SPACES}+|{_SPACES}+$', '', 'g')"


def sql_clean(expr: str) -> str:
    no_links = f"regexp_replace(coalesce({expr}, ''), 'https?://{_NO_SPACES}+', '', 'g')"
    return f"trim(regexp_replace({no_links}, '{_SPACES}+', ' ', 'g'))"


def sql_words(expr: str, alternatives: str) -> str:
    """Whole-word search where \\b is ASCII: the neighbours are spelled out."""
    return f"regexp_matches({expr}, {sql_text(f'(?i)(^|{_NOT_WORD})({alternatives})({_NOT_WORD}|$)')})"


def sql_search(expr: str, pattern: str) -> str:
    return f"regexp_matches({expr}, {sql_text('(?i)' + pattern)})"


def _sql_decision(text: str, spam: str, include: str, numeric: str, request: str, override: str) -> str:
    return f"""CASE WHEN {text} = '' THEN 'texte_vide'
        WHEN {spam} THEN 'regex_niveau1'
        WHEN NOT ({include} OR {numeric}) THEN 'regex_niveau1'
        WHEN {request} AND NOT ({override}) THEN 'regex_niveau1' END"""


def sql_test_reason(text: str) -> str:
    """reject_reason under TEST_RULES."""
    return _sql_decision(
        text,
        spam=sql_search(text, r"###|\$\$\$|copyright"),
        include=sql_words(text, "avec|pour|license|hath|mit|para"),
        numeric=sql_search(text, r"[0-9]\s*(de|la|the|c)([^0-9]|$)"),
        request=sql_words(text, r"dans|sich|that\s+the"),
        override=f"{sql_words(text, 'est|ist|with')} OR {sql_search(text, '[0-9]{4,}')}",
    )


def sql_land_reason(text: str) -> str:
    """reject_reason under the land rules, written out a second time in RE2."""
    apostrophe = "['' ]"
    include = "|".join((
        "parcelle", "terrain", "lotissement", r"non\s+loti", r"zone\s+lotie", "cession", "hectares?", "superficie", "attestation", r"titre\s+foncier",
        "tf", "puh", rf"permis\s+d{apostrophe}habiter", "apfr", r"acte\s+de\s+cession", r"papier\s+en\s+r[eè]gle", r"[àa]\s+vendre", "vente", "vendre",
        "c[ée]der", "prix", "n[ée]gociable",
    ))
    request = "|".join((
        r"je\s+recherche", r"recherche\s+une?", r"cherche\s+une?", rf"besoin\s+d{apostrophe}une?", r"suis\s+preneur",
        r"qui\s+a\s+une?\s+(terrain|parcelle)\s+[àa]\s+(vendre|proposer)",
    ))

    def word(alternatives: str) -> str:
        return f"regexp_matches({text}, '(?i)(^|[^\\pL\\pN_])({alternatives})([^\\pL\\pN_]|$)')"

    def found(pattern: str) -> str:
        return f"regexp_matches({text}, '(?i){pattern}')"

    return f"""CASE WHEN {text} = '' THEN 'texte_vide'
        WHEN {found(r"(cliquez\s+ici|gagnez\s+[0-9]|投资|forex\s+trading|crypto\s*(monnaie)?\s+gratuit)")} THEN 'regex_niveau1'
        WHEN NOT ({word(include)} OR {found(r"[0-9]\s*(m2|m²|ha)([^0-9]|$)")}) THEN 'regex_niveau1'
        WHEN {word(request)} AND NOT ({word(r"[àa]\s+vendre|vends|disponible\s+[àa]\s+la\s+vente")} OR {found(r"prix\s*:?\s*[0-9]+")})
            THEN 'regex_niveau1' END"""

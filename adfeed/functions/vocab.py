"""Strict, case-insensitive canonical spellings; unknown values are kept."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeed.functions.binding import let
from adfeed.functions.text import strip

# Accepted spellings.
ZONES = [
    "Ouaga 2000", "Karpala", "Pissy", "Saaba", "Komsilga", "Cissin", "Tanghin",
    "Gounghin", "Kossodo", "Nioko", "Bassinko", "Yagma", "Tampouy", "Zagtouli",
    "Kamboinsé", "Nongr-Massom", "Sig-Noghin", "Baskuy", "Bogodogo", "Boulmiougou",
    "Tanghin-Dassouri", "Koubri", "Loumbila", "Pabré", "Dapoya", "Zone du Bois",
    "Patte d'Oie", "Ouidi", "Kilwin", "Rimkiéta", "Yamtenga",
]
DOCUMENT_STATUSES = [
    "Titre foncier", "APFR", "PUH", "Attestation d'attribution", "Fiche d'attribution",
    "Attestation",
]
PROPERTY_TYPES = ["parcelle", "maison", "villa", "ferme", "autre"]


def canonicalise(col: Column, vocab: Sequence[str]) -> Column:
    """The vocabulary's spelling of a value, or the stripped value if it has none.

    NULL and '' become NULL; a value of whitespace only becomes ''.
    """
    spelling = F.create_map(*[F.lit(x) for x in chain.from_iterable((v.lower(), v) for v in vocab)])

    def spelled(stripped: Column) -> Column:
        return F.coalesce(F.try_element_at(spelling, F.lower(stripped)), stripped)

    return F.when(col != "", let(strip(col), spelled))


def canonicalise_join(df: DataFrame, column: str, vocab: DataFrame) -> DataFrame:
    """The same with the vocabulary as a table of one column ``valeur``."""
    spelling = vocab.select(F.lower("valeur").alias("_cle"), F.col("valeur").alias("_forme")).dropDuplicates(["_cle"])
    stripped = strip(F.col(column))
    joined = df.withColumn("_cle", F.lower(stripped)).join(spelling, "_cle", "left")
    return joined.withColumn(
        column, F.when(F.col(column) != "", F.coalesce(F.col("_forme"), stripped))
    ).drop("_cle", "_forme")

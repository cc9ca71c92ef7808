"""Files for people: CSV exports, reject audit, consultation copy of the master."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeed.functions.text import as_export_text
from adfeed.operators.upsert import latest_first
from adfeed.schemas import AD_COLUMNS, CANDIDATE_COLUMNS, MASTER

BOM = "\ufeff"
CONTACTS = "contacts_whatsapp"
TEXTS = ("texte", "texte_nettoye", "resume_court")
# Eight digits or more with at most two blanks, dots, dashes or brackets between them; no
# amounts: numbers in groups of three, or before a currency.
_GAP = r"[ ().\-\u00a0]{0,2}"
_AMOUNT_AFTER_DIGIT = r"[0-9]{0,2}(?:[ .\u00a0][0-9]{3})+(?![ .\-()\u00a0]?[0-9])"
# A table of the signs that begin a number comes first, and what has to hold around that sign after it:
# the engine passes over all other signs at once.
_FIRST = rf"[+0123456789](?<![0-9][+0-9])(?:(?<=\+)[0-9]|(?<=[0-9])(?!{_AMOUNT_AFTER_DIGIT}))"
PHONE = rf"(?i){_FIRST}(?:{_GAP}[0-9]){{5,12}}{_GAP}([0-9]){_GAP}([0-9])(?![0-9])(?!\s*(?:f\s*)?cfa)"


def protect_contacts(df: DataFrame, contacts: str = "masked") -> DataFrame:
    """Phone numbers as stored ('raw'), hashed ('hash') or with digits hidden ('masked').

    Those that a text column spells out are masked in both cases but 'raw'.
    """
    if contacts not in ("masked", "hash", "raw"):
        raise ValueError(f"contacts must be masked, hash or raw, not {contacts!r}")
    if contacts == "raw":
        return df

    def change(item: Column) -> Column:
        return F.sha2(item, 256) if contacts == "hash" else F.regexp_replace(item, r"[0-9](?=(?:[^0-9]*[0-9]){2})", "*")

    changes = {c: _masked_text(F.col(c)) for c in TEXTS if c in df.columns}
    if CONTACTS in df.columns:
        changes[CONTACTS] = F.transform(F.col(CONTACTS), change)
    return df.withColumns(changes) if changes else df


def _masked_text(text: Column) -> Column:
    """Each phone number of a text as '**' and its two last digits."""
    return F.regexp_replace(text, PHONE, "**$1$2")


def export_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The given columns as export texts; a column the table lacks is empty."""
    types = dict(df.dtypes)
    return df.select(
        *[(as_export_text(F.col(c), types[c]) if c in types else F.lit("")).alias(c) for c in columns]
    )


def write_csv(df: DataFrame, path: str, columns: Sequence[str], bom: bool = True) -> None:
    """CSV part files: CRLF, minimal quoting, a header in each, also for no rows.

    With ``bom`` every part file starts with a byte order mark, as spreadsheet
    programs want it.  A line break inside a cell is written as CRLF too.
    """
    texts = export_text(df, columns)
    if bom:
        texts = texts.withColumnRenamed(columns[0], BOM + columns[0])
    texts.write.mode("overwrite").csv(
        path, header=True, sep=",", quote='"', escape='"', lineSep="\r\n", nullValue="", emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, encoding="UTF-8",
    )


def export_ads(ads: DataFrame, path: str, bom: bool = True, contacts: str = "masked") -> None:
    write_csv(protect_contacts(ads, contacts), path, AD_COLUMNS, bom)


def export_candidates(candidates: DataFrame, path: str, bom: bool = True, contacts: str = "masked") -> None:
    write_csv(protect_contacts(candidates, contacts), path, CANDIDATE_COLUMNS, bom)


def export_master(master: DataFrame, path: str, bom: bool = True, contacts: str = "masked") -> None:
    """Overwrite the consultation copy: all columns, newest update first, part by part."""
    # Masked after the sort: what sorting first samples would be masked for the sample alone.
    write_csv(protect_contacts(latest_first(master), contacts), path, MASTER.fieldNames(), bom)


def write_rejects(level1: DataFrame, level2: DataFrame, path: str, contacts: str = "masked") -> None:
    """All rejects as JSON lines, one folder per reason, NULL fields included."""
    both = protect_contacts(level1.unionByName(level2, allowMissingColumns=True), contacts)
    both.write.mode("overwrite").partitionBy("motif_rejet").option("ignoreNullFields", "false").json(path)

"""Rule-based structuring: fills the extractor's contract without a model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adfeed.functions.binding import let
from adfeed.functions.rules import LAND_RULES, RuleSet, folded, found, may_hold
from adfeed.functions.text import java_pattern, strip
from adfeed.functions.vocab import DOCUMENT_STATUSES, PROPERTY_TYPES, ZONES, canonicalise

SQUARE_METRES_PER_HECTARE = 10_000

# The last group of each amount catches a letter that follows the unit: such a
# match is no amount ("5 habitants").  The only look-around asks for the first sign of a
# match once more, as a table of signs: the engine passes over all other signs at once.
PHONE = r"(?i)(?=[+0123456789])\+?[0-9][0-9 ()-]*[0-9](\s*f?\s*cfa)?"
PHONE_DIGITS = (8, 15)
AREA = r"(?i)([0-9]+(?:[.,][0-9]+)?)\s*(m2|m²|hectares?|ha)([\p{L}\p{N}_]?)"
PRICE = r"(?i)(?=[0123456789])([0-9]{1,3}(?:[\s.][0-9]{3})+|[0-9]+)\s*(f?\s*cfa)([\p{L}\p{N}_]?)"


def contacts(col: Column) -> Column:
    """Phone numbers as written, in order of appearance, each once.

    A number of 8 to 15 digits that is neither a price nor grouped by thousands.
    """
    found = F.regexp_extract_all(col, F.lit(PHONE), F.lit(0))

    def is_phone(item: Column) -> Column:
        digits = F.length(F.regexp_replace(item, "[^0-9]", ""))
        amount = F.lower(item).endswith("a") | item.rlike(r"^[0-9]{1,3}( [0-9]{3})+$")
        return digits.between(*PHONE_DIGITS) & ~amount

    return F.array_distinct(F.filter(found, is_phone))


def only_value(values: Column) -> Column:
    """The single distinct element of an array; NULL where there is none or a choice."""
    return let(F.array_distinct(values), lambda distinct: F.when(F.size(distinct) == 1, F.element_at(distinct, 1)))


def _amounts(col: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(col, F.lit(pattern), F.lit(0))
    return F.filter(found, lambda item: F.regexp_extract(item, pattern, 3) == "")


def area_m2(col: Column) -> Column:
    """Area in whole square metres, hectares converted; NULL if several are named."""

    def in_m2(item: Column) -> Column:
        number = F.replace(F.regexp_extract(item, AREA, 1), F.lit(","), F.lit(".")).try_cast("decimal(28,6)")
        hectares = F.lower(F.regexp_extract(item, AREA, 2)).startswith("h")
        metres = F.when(hectares, number * SQUARE_METRES_PER_HECTARE).otherwise(number)
        return F.when(metres == F.floor(metres), metres.try_cast("bigint"))

    return only_value(F.transform(_amounts(col, AREA), in_m2))


def price(col: Column) -> Column:
    """Price in whole currency units; NULL if several are named."""

    def units(item: Column) -> Column:
        return F.regexp_replace(F.regexp_extract(item, PRICE, 1), "[^0-9]", "").try_cast("bigint")

    return F.when(F.lower(col).contains("cfa"), only_value(F.transform(_amounts(col, PRICE), units)))


def first_named(col: Column, vocab: Sequence[str], fold: Column | None = None) -> Column:
    """The first vocabulary entry named as whole words, the longest that starts there.

    ``fold``: ``folded(col)`` where the caller has it; texts without a stem of any entry are not searched.
    """
    pattern = rf"\b(?:{'|'.join(_literal(v) for v in sorted(vocab, key=len, reverse=True))})\b"

    def searched(fold: Column) -> Column:
        first = F.when(may_hold(fold, pattern), F.regexp_extract(col, java_pattern(pattern), 0))
        return let(first, lambda named: F.when(named != "", canonicalise(named, vocab)))

    return let(folded(col), searched) if fold is None else searched(fold)


def keywords(col: Column, rules: RuleSet = LAND_RULES) -> Column:
    """Rule keywords found in the text, lower case, each once."""
    found = F.regexp_extract_all(col, F.lit(java_pattern(rules.include)), F.lit(0))
    return F.array_distinct(F.transform(found, F.lower))


def first_sentence(col: Column, max_words: int = 25) -> Column:
    words = F.split(strip(F.regexp_extract(col, r"^[^.!?]*[.!?]?", 0)), " ")
    return F.array_join(F.slice(words, 1, max_words), " ")


def rule_extract(
    col: Column,
    rules: RuleSet = LAND_RULES,
    zones: Sequence[str] = tuple(ZONES),
    statuses: Sequence[str] = tuple(DOCUMENT_STATUSES),
) -> Column:
    """JSON answer in the extractor's contract, taken from the text by rules only."""
    kinds = [kind for kind in PROPERTY_TYPES if kind != "autre"]

    def answer(fold: Column) -> Column:
        return F.struct(
            found(col, fold, rules.override).alias("est_une_annonce_valide"),
            F.coalesce(first_named(col, kinds, fold), F.lit("autre")).alias("type_bien"),
            first_named(col, zones, fold).alias("quartier_zone"),
            area_m2(col).alias("superficie_m2"),
            price(col).alias("prix_fcfa"),
            first_named(col, statuses, fold).alias("statut_document"),
            contacts(col).alias("contacts_whatsapp"),
            keywords(col, rules).alias("mots_cles_pertinents"),
            first_sentence(col).alias("resume_court"),
        )

    return F.to_json(let(folded(col), answer), {"ignoreNullFields": "false"})


def _literal(value: str) -> str:
    return "".join(c if c.isalnum() or c in " '" else "\\" + c for c in value)

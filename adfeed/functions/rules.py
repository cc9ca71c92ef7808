"""Rule sets that decide which posts are plausible offers."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache, reduce
from operator import or_
from re import _constants as _kind
from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F

from adfeed.functions.binding import let
from adfeed.functions.text import is_blank, matches

# Reasons of rejects.
EMPTY_TEXT = "texte_vide"
FAILED_RULES = "regex_niveau1"


@dataclass(frozen=True)
class RuleSet:
    """Patterns of one market; all are searched ignoring case."""

    include: str   # at least one keyword, or ...
    numeric: str   # ... a number with a unit
    request: str   # a wish to buy, rejected unless ...
    override: str  # ... a sale signal is there too
    spam: str      # rejected first
    rental: str | None = None  # tag only, never a filter


# The vocabulary of the land market rules.
LAND_WORDS = [
    r"parcelle", r"terrain", r"lotissement", r"non\s+loti", r"zone\s+lotie",
    r"cession", r"hectares?", r"superficie",
]
DOCUMENT_WORDS = [
    r"attestation", r"titre\s+foncier", r"\btf\b", r"puh", r"permis\s+d[' ]habiter",
    r"apfr", r"acte\s+de\s+cession", r"papier\s+en\s+r[eè]gle",
]
TRANSACTION_WORDS = [
    r"\b[àa]\s+vendre\b", r"\bvente\b", r"\bvendre\b", r"\bc[ée]der\b", r"\bprix\b",
    r"n[ée]gociable",
]
LAND_RULES = RuleSet(
    # The boundary around the list makes the ones around its words superfluous.
    include=r"\b(?:" + "|".join(LAND_WORDS + DOCUMENT_WORDS + TRANSACTION_WORDS).replace(r"\b", "") + r")\b",
    numeric=r"\d\s*(m2|m²|ha)(?=\D|$)",
    request=(
        r"\b(je\s+recherche|recherche\s+un[e]?|cherche\s+un[e]?|besoin\s+d[' ]un[e]?|"
        r"suis\s+preneur|qui\s+a\s+un[e]?\s+(terrain|parcelle)\s+[àa]\s+(vendre|proposer))\b"
    ),
    override=r"\b([àa]\s+vendre|vends|disponible\s+[àa]\s+la\s+vente)\b|prix\s*:?\s*\d+",
    spam=r"(cliquez\s+ici|gagnez\s+\d|投资|forex\s+trading|crypto\s*(monnaie)?\s+gratuit)",
    rental=r"\b(location|louer|loyer|bail)\b",
)


# Letters that match others ignoring case although lower() keeps them apart, and what they match.
ODD_CASES = ("\u017f\u0131\u0130\u212a\u212b", "siik\u00e5")
# Letters whose case is settled by lower() and ODD_CASES; stems hold these and signs without case.
PLAIN = re.compile("[ -~\u00e0-\u00f6\u00f8-\u00fe]")
MOST_STEMS = 64


def folded(col: Column) -> Column:
    """A text in which a stem stands wherever its pattern could match ignoring case.

    Few texts hold an odd letter, and to look for them takes a small part of the time to replace them.
    """
    odd = reduce(or_, [col.contains(letter) for letter in ODD_CASES[0]])
    return F.lower(F.when(odd, F.translate(col, *ODD_CASES)).otherwise(col))


@lru_cache
def stems(pattern: str) -> tuple[str, ...] | None:
    """Texts of which every match of a pattern holds one, in lower case; None where that can't be told.

    Of each alternative the longest run of letters that it can't do without, small classes
    of letters written out. A stem that holds another one adds nothing and goes.
    """
    found = _needed(_parser.parse(pattern))
    if not found or min(map(len, found)) < 2 or len(found) > MOST_STEMS:
        return None
    return tuple(sorted(s for s in found if not any(t != s and t in s for t in found)))


def _letter(code: int) -> str | None:
    char = chr(code).lower()
    return char if len(char) == 1 and (PLAIN.match(char) or char == char.upper()) else None


def _spellings(kind, value) -> list[str] | None:
    """What one letter, or a small class of them, can be."""
    if kind is _kind.LITERAL:
        chars = [_letter(value)]
    elif kind is _kind.IN and len(value) <= 4 and all(k is _kind.LITERAL for k, _ in value):
        chars = [_letter(v) for _, v in value]
    else:
        return None
    return None if None in chars else sorted(set(chars))


def _needed(sequence) -> set[str] | None:
    """The best set of stems for a sequence of pattern parts: the one whose shortest stem is longest."""
    choices: list[set[str]] = []
    run = {""}
    for kind, value in [*sequence, (None, None)]:
        chars = _spellings(kind, value)
        if chars and len(run) * len(chars) <= 8:
            run = {r + c for r in run for c in chars}
            continue
        choices.append(run)
        run = set(chars) if chars else {""}
        inner = None
        if kind is _kind.BRANCH:
            parts = [_needed(p) for p in value[1]]
            inner = None if None in parts else set().union(*parts)
        elif kind is _kind.SUBPATTERN:
            inner = _needed(value[-1])
        elif kind in (_kind.MAX_REPEAT, _kind.MIN_REPEAT, _kind.POSSESSIVE_REPEAT) and value[0] > 0:
            inner = _needed(value[2])
        if inner:
            choices.append(inner)
    best = max(choices, key=lambda c: (min(map(len, c)), -len(c)))
    return best if min(map(len, best)) else None


def may_hold(folded_text: Column, pattern: str) -> Column:
    """False only for texts without a match: those that hold no stem of the pattern."""
    held = stems(pattern)
    if held is None:
        return F.lit(True)
    return F.coalesce(reduce(or_, [folded_text.contains(stem) for stem in held]), F.lit(False))


def found(text: Column, folded_text: Column, pattern: str) -> Column:
    """``matches``, tried only on texts that hold a stem of the pattern."""
    return may_hold(folded_text, pattern) & matches(text, pattern)


def is_candidate(col: Column, rules: RuleSet = LAND_RULES) -> Column:
    """True where a text passes the rules.

    The result does not depend on the order of the tests, so the ones that are
    cheap or settle most texts come first and the rest is not evaluated. A pattern is
    tried only on texts that hold one of its stems.
    """

    def decided(fold: Column) -> Column:
        wanted = found(col, fold, rules.numeric) | found(col, fold, rules.include)
        pure_request = found(col, fold, rules.request) & ~found(col, fold, rules.override)
        return (
            F.when(is_blank(col), False)
            .when(~wanted, False)
            .when(found(col, fold, rules.spam), False)
            .otherwise(~pure_request)
        )

    return let(folded(col), decided)


def reject_reason(clean: Column, rules: RuleSet = LAND_RULES) -> Column:
    """Reason a cleaned text is rejected for; NULL for a candidate."""
    return F.when(F.coalesce(clean, F.lit("")) == "", EMPTY_TEXT).when(
        ~is_candidate(clean, rules), FAILED_RULES
    )


def rental_tag(col: Column, rules: RuleSet = LAND_RULES) -> Column:
    """True where a text speaks of renting."""
    if rules.rental is None:
        return F.lit(False)
    return let(folded(col), lambda fold: found(col, fold, rules.rental))

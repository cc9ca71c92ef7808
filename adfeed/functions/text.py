"""Text cleaning and text predicates.

Patterns are written in the common regex dialect and matched with the rules of
Unicode strings: ``\\s`` includes U+001C..U+001F and the no-break spaces, and a
word character is a letter, a number or an underscore (combining marks and
emoji selectors are not).  Java's own ``\\b`` differs on marks, so the boundary
is spelled out.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x1c-\x1f]"
NOT_SPACE = r"[^\s\x1c-\x1f]"
WORD = r"[\p{L}\p{N}_]"
WORD_START = rf"(?<!{WORD})"
WORD_END = rf"(?!{WORD})"


def java_pattern(pattern: str, ignore_case: bool = True) -> str:
    """The Java form of a Unicode pattern, to be used with rlike and regexp_*.

    A ``\\b`` must touch a word character of the pattern, so that one look to the
    other side decides it; the full test on both sides takes three times as long.
    """
    ends_replaced = re.sub(r"\\b(?=$|[|)])", lambda _: WORD_END, pattern)
    flags = "(?iU)" if ignore_case else "(?U)"
    return flags + ends_replaced.replace(r"\b", WORD_START).replace(r"\s", SPACE)


def matches(col: Column, pattern: str) -> Column:
    """True where the pattern occurs anywhere, ignoring case; NULL text is False."""
    return F.coalesce(col.rlike(java_pattern(pattern)), F.lit(False))


def strip(col: Column) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.regexp_replace(col, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def is_blank(col: Column) -> Column:
    """True for NULL, '' and whitespace only; stops at the first other character."""
    return ~F.coalesce(col.rlike(rf"(?U){NOT_SPACE}"), F.lit(False))


def clean_text(col: Column) -> Column:
    """Drop links, collapse whitespace, strip; NULL becomes the empty string."""
    without_links = F.regexp_replace(F.coalesce(col, F.lit("")), rf"(?U)https?://{NOT_SPACE}+", "")
    return F.trim(F.regexp_replace(without_links, rf"(?U){SPACE}+", " "))


def is_permalink(col: Column) -> Column:
    """True for the address of a single post (profile addresses are not)."""
    return F.coalesce(col.contains("/posts/") | col.contains("/permalink/"), F.lit(False))


def mask_credentials(col: Column) -> Column:
    """Hide the password in every ``scheme://user:password@`` of a text."""
    return F.regexp_replace(col, r"://([^:/@]+):([^@]+)@", r"://$1:***@")


def strip_json_guard(col: Column) -> Column:
    """Remove one leading ``for (;;);`` from a response body."""
    return F.regexp_replace(col, r"^for \(;;\);", "")


def body_documents(col: Column) -> Column:
    """Candidate JSON documents of a response body: the whole body and each line.

    Line breaks are those of Unicode text, blanks are dropped, and a one-line
    body is kept once.
    """
    body = strip_json_guard(F.coalesce(col, F.lit("")))
    lines = F.split(body, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")
    parts = F.transform(F.concat(F.array(body), lines), strip)
    return F.filter(F.array_distinct(parts), lambda part: part != "")


def html_json_blobs(col: Column) -> Column:
    """Bodies of all ``<script type="application/json" ...>`` elements, in order."""
    return F.regexp_extract_all(
        col, F.lit(r'(?s)<script type="application/json"[^>]*>(.*?)</script>'), F.lit(1)
    )


def as_export_text(col: Column, data_type: str) -> Column:
    """Text form used by the exports: NULL is '', a list is joined by '; '."""
    if data_type.startswith("array"):
        return F.coalesce(F.array_join(col.cast("array<string>"), "; ", "None"), F.lit(""))
    if data_type == "boolean":
        return F.coalesce(F.initcap(col.cast("string")), F.lit(""))
    if data_type == "timestamp":
        return F.coalesce(iso_text(col), F.lit(""))
    return F.coalesce(col.cast("string"), F.lit(""))


def iso_text(col: Column) -> Column:
    """ISO text of a UTC timestamp; microseconds only where there are any."""
    seconds = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    whole = F.unix_micros(col) % 1_000_000 == 0
    return F.concat(F.when(whole, seconds).otherwise(micros), F.lit("+00:00"))

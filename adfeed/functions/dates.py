"""Publication dates: relative French texts and epoch seconds. All in UTC."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from adfeed.functions.binding import let
from adfeed.functions.text import SPACE, strip

# Accepted words.
INSTANT_TEXTS = ["à l'instant", "a l'instant", "just now", "il y a quelques secondes"]
MONTHS = {
    "janvier": 1, "février": 2, "fevrier": 2, "mars": 3, "avril": 4, "mai": 5, "juin": 6,
    "juillet": 7, "août": 8, "aout": 8, "septembre": 9, "octobre": 10, "novembre": 11,
    "décembre": 12, "decembre": 12,
}
UNIT_SECONDS = {"min": 60, "h": 3600, "j": 86400}
DEFAULT_DAYS_BACK = {"daily": 1, "backfill": 7}

_CUT = "\x1f"
_CLOCK = rf"(?:{SPACE}+[àa]{SPACE}+([0-9]{{1,2}})[:h]([0-9]{{2}}))?"
_AGE = rf"(?U)^([0-9]+){SPACE}*(min|h|j)$"
_NEAR_DAY = rf"(?U)^(hier|aujourd'?hui){_CLOCK}$"
_CALENDAR_DAY = rf"(?U)^([0-9]{{1,2}}){SPACE}+({'|'.join(MONTHS)})(?:{SPACE}+([0-9]{{4}}))?{_CLOCK}$"
# Seconds from 0001-01-01 to the epoch, and the last second of year 9999.
_FIRST_SECOND = 62_135_596_800
_LAST_SECOND = 253_402_300_800


def _lookup(mapping: dict, key: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(pairs, key)


def _if_whole(text: Column, pattern: str, count: int, body: Callable[[Column], Column]) -> Column:
    """``body`` of the groups of a whole-text pattern ('' for an absent one); NULL without a match."""
    marked = F.regexp_replace(text, pattern, "".join(f"{_CUT}${i + 1}" for i in range(count)))

    # A stripped text does not start with the mark, so only a match does.
    def read(result: Column) -> Column:
        return F.when(result.startswith(_CUT), let(F.slice(F.split(result, _CUT), 2, count), body))

    return let(marked, read)


def _number(text: Column, kind: str = "int") -> Column:
    return text.try_cast(kind)


def parse_relative_ts(col: Column, now: Column | datetime) -> Column:
    """Timestamp meant by a displayed date text, seen at ``now``; NULL if unclear.

    Known forms: "12 min", "3 h", "5 j", "hier [à 14:30]", "aujourd'hui [à 9h15]",
    "3 mars [2024] [à 18:45]" and a few words for this moment.  A calendar day
    without a clock means noon; without a year it is the latest such day that is
    not in the future.  Impossible days and hours give NULL.
    """
    at = now if isinstance(now, Column) else F.lit(now)

    def aged(parts: Column) -> Column:
        seconds = _number(parts[0], "bigint") * _lookup(UNIT_SECONDS, parts[1])
        reachable = (F.length(parts[0]) <= 12) & (seconds <= F.unix_seconds(at) + _FIRST_SECOND)
        return F.when(reachable, F.timestamp_micros(F.unix_micros(at) - seconds * 1_000_000))

    def near_day(parts: Column) -> Column:
        today = at.cast("date")
        day = F.when(parts[0] == "hier", F.date_sub(today, 1)).otherwise(today)
        return _timestamp(
            F.year(day), F.month(day), F.dayofmonth(day),
            F.coalesce(_number(parts[1]), F.lit(0)), F.coalesce(_number(parts[2]), F.lit(0)),
        )

    def calendar_day(parts: Column) -> Column:
        def in_year(year: Column) -> Column:
            return _timestamp(
                year, _lookup(MONTHS, parts[1]), _number(parts[0]),
                F.coalesce(_number(parts[3]), F.lit(12)), F.coalesce(_number(parts[4]), F.lit(0)),
            )

        def this_or_last(this: Column) -> Column:
            return F.when(this > at, in_year(F.year(at) - 1)).otherwise(this)

        # year 0 does not exist
        return F.when(parts[2] == "", let(in_year(F.year(at)), this_or_last)).when(
            _number(parts[2]) >= 1, in_year(_number(parts[2]))
        )

    def parse(text: Column) -> Column:
        return F.coalesce(
            F.when(text.isin(*INSTANT_TEXTS), at),
            _if_whole(text, _AGE, 2, aged),
            _if_whole(text, _NEAR_DAY, 3, near_day),
            _if_whole(text, _CALENDAR_DAY, 5, calendar_day),
        )

    return let(F.lower(strip(col)), parse)


def _timestamp(year: Column, month: Column, day: Column, hour: Column, minute: Column) -> Column:
    return F.try_make_timestamp(year, month, day, hour, minute, F.lit(0), F.lit("UTC"))


def epoch_ts(col: Column) -> Column:
    """UTC timestamp of plausible epoch seconds (> 1e9); NULL beyond year 9999."""
    whole = F.floor(col)
    micros = whole * 1_000_000 + F.bround((col - whole) * 1_000_000, 0).cast("bigint")
    return F.when((col > 1_000_000_000) & (col < _LAST_SECOND), F.timestamp_micros(micros))


def window_cutoff(now: Column | datetime, mode: str = "daily", days_back: int | None = None) -> Column:
    """Oldest moment a collection run looks back to."""
    days = DEFAULT_DAYS_BACK[mode] if days_back is None else days_back
    if days <= 0:
        raise ValueError("days_back must be positive")
    at = now if isinstance(now, Column) else F.lit(now)
    return at - F.expr(f"INTERVAL {days} DAYS")

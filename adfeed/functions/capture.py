"""Quality label of stored pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adfeed.functions.binding import let

OK = "ok"
BLOCKED = "blocked"
SESSION_EXPIRED = "session_expired"

# Signs of a page that is not the wanted one (lower case).
BLOCKED_URL_PARTS = ["checkpoint", "login.php", "recover"]
BLOCKED_PHRASES = [
    "nous voulons juste vérifier", "confirmez votre identité", "action inhabituelle",
    "we just want to make sure",
]
ANONYMOUS_MARKS = ['"user_id":"0"', '"actorid":"0"']
LOGIN_FORM = r"""<input\b[^>]*\sname\s*=\s*["']?pass["'\s/>]|<[a-z][^>]*\sid\s*=\s*["']?login_form["'\s/>]"""


def _contains_any(col: Column, needles: Sequence[str]) -> Column:
    found = F.lit(False)
    for needle in needles:
        found = found | F.coalesce(col.contains(needle), F.lit(False))
    return found


def capture_status(
    url: Column,
    html: Column,
    url_parts: Sequence[str] = tuple(BLOCKED_URL_PARTS),
    phrases: Sequence[str] = tuple(BLOCKED_PHRASES),
    marks: Sequence[str] = tuple(ANONYMOUS_MARKS),
    login_form: str = LOGIN_FORM,
) -> Column:
    """One of ok, blocked, session_expired; the first sign that applies decides."""
    address = F.lower(url)

    def by_content(body: Column) -> Column:
        return (
            F.when(_contains_any(body, phrases), BLOCKED)
            .when(_contains_any(body, marks), SESSION_EXPIRED)
            .when(F.coalesce(body.rlike(login_form), F.lit(False)), SESSION_EXPIRED)
            .otherwise(OK)
        )

    return F.when(_contains_any(address, url_parts), BLOCKED).otherwise(let(F.lower(html), by_content))

"""Using a computed value several times in one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once.

    Written out plainly, a costly value would be computed again at each use
    inside conditions, filters and generators.
    """
    return F.element_at(F.transform(F.array(value), body), 1)

"""Value checks on typed fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adfeed.functions.vocab import PROPERTY_TYPES


def non_negative(col: Column) -> Column:
    """Negative numbers become NULL; zero is kept."""
    return F.when(col >= 0, col)


def unknown_value(col: Column, allowed: Sequence[str] = tuple(PROPERTY_TYPES)) -> Column:
    """Quality flag for a value outside a closed list; the value itself is kept."""
    return ~F.coalesce(col.isin(*allowed), F.lit(False))


def false_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(False))


def anomaly_ratio(anomalies: Column, total: Column) -> Column:
    """Share of failed groups of a run; 0 for a run without groups."""
    return F.when(total > 0, anomalies / total).otherwise(F.lit(0.0))

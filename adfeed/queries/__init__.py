"""Registered queries: each operator on the shared test tables, with SQL to compare.

A module holds QUERIES, name -> function(spark, folder), and ORACLE, name -> SQL
for DuckDB with the same result columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeed.queries import collection, filtering, outputs, runs, structuring
from adfeed.session import configure

_MODULES = (filtering, structuring, runs, collection, outputs)


# Integer columns that may be NULL. They are reported as a number that none of them can
# be otherwise: table tools differ in how they show a missing integer.
MISSING = -999_999_999_999_999
MAY_BE_NULL = {
    "amounts_extract": ["superficie_m2", "prix_fcfa"],
    "validate_output": ["valide", "superficie_m2", "prix_fcfa"],
    "route_counts": ["prix"],
    "structure_answers": ["superficie_m2", "prix_fcfa"],
    "page_records": ["publie_us"],
    "relative_dates": ["date_us"],
    "epoch_dates": ["date_us"],
    "feed_catchup_posts": ["date_us"],
    "feed_catchup_groups": ["plus_ancien_us"],
    "oldest_in_step": ["plus_ancien_us"],
}


def _prepared(name: str, query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = query(configure(spark), folder)
        return result.withColumns({c: F.coalesce(c, F.lit(MISSING)) for c in MAY_BE_NULL.get(name, [])})

    run.__doc__ = query.__doc__
    return run


def _reported(name: str, sql: str) -> str:
    changed = ", ".join(f"coalesce({c}, {MISSING}) AS {c}" for c in MAY_BE_NULL.get(name, []))
    return f"SELECT * REPLACE ({changed}) FROM ({sql})" if changed else sql


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _prepared(name, query) for module in _MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: _reported(name, sql) for module in _MODULES for name, sql in module.ORACLE.items()}

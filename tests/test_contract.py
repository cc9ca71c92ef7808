"""The registered queries: names, plans, and agreement of names with their SQL."""

import re

import pytest

import __spark_entry__ as contract

SMALL = "/root/testdata/sf0.001"
QUERIES = {n: q for n, q in contract.queries().items() if not re.match(r"op\d+_|pipeline$", n)}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_multiplies_tables_or_deals_rows_out(spark, name):
    """With the plans of large inputs; small ones are dealt to all cores, see test_only_small_inputs_are_spread."""
    spark.conf.set("spark.adfeed.spread", "false")
    try:
        text = plan(QUERIES[name](spark, SMALL))
    finally:
        spark.conf.unset("spark.adfeed.spread")
    assert not [w for w in ("CartesianProduct", "BroadcastNestedLoopJoin", "RoundRobinPartitioning") if w in text]


def test_columns_are_pruned_and_filters_pushed(spark):
    text = plan(QUERIES["drift_check_last"](spark, SMALL))
    assert "props" not in text
    text = plan(QUERIES["unseen_posts"](spark, SMALL))
    assert "value" not in re.findall(r"ReadSchema: (\S+)", text)[0]
    scan = spark.read.parquet(f"{SMALL}/events.parquet").filter("user_id < 5").select("ts")
    assert "PushedFilters: [IsNotNull(user_id), LessThan(user_id,5)]" in plan(scan)

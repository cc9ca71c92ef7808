"""One local session for the whole suite. All texts are invented."""

from __future__ import annotations

import tempfile

import pytest

from adfeed.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g", shared=tempfile.mkdtemp(prefix="adfeed-shared-"))
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A fresh folder under /tmp."""
    return tempfile.mkdtemp(prefix="adfeed-test-")


@pytest.fixture
def evaluate(spark):
    """Values of a column function over one text column: evaluate(fn, [texts])."""

    def run(function, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i INT, v {kind}")
        out = df.select("i", function(df["v"]).alias("r")).collect()
        return [r["r"] for r in sorted(out, key=lambda r: r["i"])]

    return run

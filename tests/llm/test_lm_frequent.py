"""No token is more likely than certain, however often its pair is counted."""

import numpy as np
import pytest

from adfeed.llm.common import ready
from adfeed.llm.lm import bloom_piece, CountFilter, language_scores


# Six of seven documents are learned from: pairs counted about 5,000 and nearly 10^6 times.
@pytest.mark.parametrize("copies, passages", [(5_850, 1), (2_280, 500)])
def test_no_probability_over_one(spark, copies, passages):
    ready(spark)
    text = " ".join(["one two three four"] * passages)
    docs = spark.range(copies).selectExpr("id AS doc_id", f"'{text}' AS text")
    rows = language_scores(docs).select("score", "n_tokens").distinct().collect()
    assert all(-0.2 * r["n_tokens"] < r["score"] <= 0 for r in rows)


def test_counts_are_read_within_five_percent():
    keys = np.unique(np.random.default_rng(6).integers(0, 2**63, 2000, dtype=np.uint64)) & np.uint64(0xFFFFFFFFFFFF0000)
    counts = np.full(len(keys), 5_000)
    counts[::2] = 1_000_000
    read = CountFilter(1, 0, 1, {0: bloom_piece(keys, counts)}).counts(keys)
    assert (np.abs(read / counts - 1) < 0.055).mean() > 0.95

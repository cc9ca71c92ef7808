"""What goes on after the first filter does not hang on how full the cells of rarity are."""

import random

from adfeed.llm import jaccard
from adfeed.llm.common import ready
from adfeed.llm.jaccard import grouped
from tests.llm.test_jaccard import brute


def test_lone_documents_are_settled_when_all_cells_are_full(spark, monkeypatch):
    """300 lone documents and 12 near copies: sets are kept for those with a partner, in several splits and pieces."""
    ready(spark)
    for name, value in (("CELL_BITS", 8), ("SLICE_BITS", 6), ("SPLIT_BYTES", 4000), ("SHINGLES_AT_ONCE", 900)):
        monkeypatch.setattr(jaccard, name, value)
    kept, before = {}, jaccard.written

    def written(df, purpose):
        kept[purpose] = before(df, purpose)
        return kept[purpose]

    monkeypatch.setattr(jaccard, "written", written)
    draw = random.Random(21)
    line = "a line that all documents have in them "
    rows = [(i, line + " ".join(f"w{draw.randrange(10**9)}" for _ in range(draw.choice([30, 60, 90])))) for i in range(300)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(12)]
    rows += [(2000, None), (2001, ""), (2002, "few words"), (2003, "Few words"), (None, rows[20][1]), (21, rows[21][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in grouped(docs, 4, 85).collect()), key=str)
    assert got == brute(rows, 4, 85)
    assert 30 <= kept["tokens"].where("digest is not null").count() <= 34  # 12 and their copies, and three more pairs; all of them before


def test_open_documents_bound(spark):
    """Row keys at both ends of their range; every document with a partner is held."""
    ready(spark)
    draw = random.Random(5)
    texts = [" ".join(f"w{draw.randrange(10**9)}" for _ in range(50)) for _ in range(6)]
    rows = [(-(2**63), texts[0]), (2**63 - 1, texts[0]), (-1, texts[1]), (0, texts[1]), (1 << 61, texts[2]), (3 << 60, texts[3]), (-5 << 60, texts[4]), (-3 << 60, "")]
    found = jaccard.open_documents(spark.createDataFrame(rows, "row_key long, text string"), 4, 85)
    assert found.holds([k for k, _ in rows]).tolist() == [True] * 4 + [False] * 4 and found.holds([]).tolist() == []

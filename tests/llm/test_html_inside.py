"""Differencing inside the container: lines of most pages go, paragraphs of a few stay."""

from adfeed.llm.common import ready
from adfeed.llm.html import main_texts


def test_lines_that_most_articles_repeat_go(spark):
    ready(spark)
    page = "<nav>Home</nav><article><h1>Title {0}</h1><p>Story {0} begins.</p><p>Subscribe for more.</p><p>Story {0} ends.</p>{1}</article>"
    rows = [(i, f"http://a.x/{i}", page.format(i, "<p>A paragraph of three.</p>" if i < 3 else "")) for i in range(12)]
    rows += [(100 + i, f"http://few.x/{i}", page.format(i, "")) for i in range(3)]
    got = {r["page_id"]: (r["text"].split("\n"), r["n_shared"]) for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    for i in range(12):
        assert got[i][0] == [f"Title {i}", f"Story {i} begins.", f"Story {i} ends."] + ["A paragraph of three."] * (i < 3) and got[i][1] == 2
    assert all("Subscribe for more." in got[100 + i][0] for i in range(3))

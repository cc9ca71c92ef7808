"""Comments, notices and adverts that outweigh the story; long and repetitive pages."""

import random
import time

import pytest

from adfeed.llm import html, queries
from adfeed.llm.html import common_lines, page_lines, settled

STORY = [f"Paragraph {i} of the story is told in more than ten plain words." for i in range(3)]
BODY = "".join(f"<p>{p}</p>" for p in STORY)
OTHER = "".join(f"<p>Some other text {i} that goes on for many more words than the story itself does, again and again and again.</p>" for i in range(6))
COMMENTS = "".join(f'<article class="comment-body"><p>A reader says {i} that they liked the piece a lot and then some more words.</p></article>' for i in range(5))


def lines(page):
    return [text for _, text in settled(page_lines(page))[0]]


@pytest.mark.parametrize("page", [
    f'<main><div>{BODY}</div><div id="comments">{COMMENTS}</div></main>',
    f'<main><div>{BODY}</div>{COMMENTS}</main>',
    f'<article>{BODY}<section class="comments">{OTHER}</section></article>',
    f'<article>{BODY}<div class="related-posts">{OTHER}</div></article>',
    f'<article>{BODY}<aside-box class="sponsored">{OTHER}</aside-box></article>',
    f'<article>{BODY}<form action="x">{OTHER}</form></article>',
    f'<div class="cookie-notice">{OTHER}</div><div>{BODY}</div>',
    f'<div>{BODY}</div><form>{OTHER}</form>',
    f'<article class="post comments-open">{BODY}<ol class="comment-list">{OTHER}</ol></article>',
    f'<div class="sidebar">{OTHER}</div><main>{BODY}</main>',
])
def test_parts_that_outweigh_the_story_go(page):
    assert lines(page) == STORY


def test_a_frame_around_the_heading_stays():
    assert lines(f"<p>A line of more than ten words that stands before the frame of it.</p><div class=social><h1>Title</h1>{BODY}{OTHER}</div>")[1:5] == ["Title", *STORY]


def brute(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


@pytest.mark.parametrize("bits", [1 << 28, 30])
def test_longest_common_subsequence(monkeypatch, bits):
    monkeypatch.setattr(html, "TABLE_BITS", bits)
    draw = random.Random(3)
    for _ in range(400):
        kinds = draw.choice([2, 4, 30])
        a, b = ([draw.randrange(kinds) for _ in range(draw.randint(0, 40))] for _ in range(2))
        found = common_lines(a, b)
        assert found == sorted(set(found)) and len(found) == brute(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in found)  # in the order of the other page


def test_twenty_thousand_equal_cells():
    begin = time.process_time()
    found = common_lines([1, *[7] * 20_000, 2, 3], [4, *[7] * 21_000, 5, 2])
    assert len(found) == 20_001 and time.process_time() - begin < 60


def test_thousands_of_open_tags():
    begin = time.process_time()
    page = "<article>" + "<span class=widget>x " * 3000 + f"</article><main>{BODY}</main>"
    assert page_lines(page) and time.process_time() - begin < 20


def test_query_meets_its_contract(spark):
    out = queries.QUERIES["op1_page_differencing"](spark, "/root/testdata/sf0.001")
    kinds = dict(out.dtypes)
    assert {n: kinds[n] for n in ("page_id", "url", "text", "n_chars")} == {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}
    rows = out.collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
    assert all(r["text"] is not None and len(r["text"]) == r["n_chars"] for r in rows) and sum(r["n_chars"] > 0 for r in rows) > 0.9 * len(rows)

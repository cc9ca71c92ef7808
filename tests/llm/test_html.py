"""Main texts: markup, alignment, and pages that only differencing can part."""

import random

from pyspark.sql import functions as F

from adfeed.llm.common import ready
from adfeed.llm.html import common_lines, main_texts, page_lines, settled, url_prefixes


def lines(page):
    return [text for _, text in settled(page_lines(page))[0]]


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    draw = random.Random(2)
    for _ in range(2000):
        a, b = ([draw.randint(0, 5) for _ in range(draw.randint(0, 12))] for _ in range(2))
        found = common_lines(a, b)
        rest = iter(b)
        assert len(found) == longest(a, b) and found == sorted(set(found)) and all(any(x == y for y in rest) for x in (a[i] for i in found))


def test_markup():
    cases = [
        ("<article><h1>T</h1><p>a &amp; b<br>c</p><p>d", ["T", "a & b c", "d"]),
        ("<nav>m</nav><article>x<aside>s</aside><form>f</form><div class='comments'><p>c</p></div>y</article><footer>z</footer>", ["x", "y"]),
        ("<header>site</header><article><header><h1>T</h1></header><p>t</p></article>", ["T", "t"]),
        ("<ARTICLE><P>A<B>b</B>c<p>n<script>if(a<b)x</script>m<style>p{}</style></ARTICLE>", ["Abc", "nm"]),
        ("<article><p>a<!-- <p>no --> b</p><p title='x>y'>c</p><img alt=z><p hidden>h</p></article>", ["a b", "c"]),
        ("<main><p>m</p><article><p>a</p></article></main>", ["a"]),
        ("<div role='main'><p>m</p></div><div>o</div>", ["m"]),
        ("<div class='ad-slot'>buy</div><div id=sidebar>s</div><p>t&nbsp; \n u", ["t u"]),
        ("<article><p>&lt;p&gt; &#233; &#x1F44D; &am &amp", ["<p> é \U0001F44D &am &"]),
        ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><blockquote>q</blockquote></article>", ["one", "two", "a", "b", "q"]),
        ("<article><p>cut <a href='x", ["cut"]),
        ("plain text", ["plain text"]),
        ("<article><textarea>t</textarea><noscript>n</noscript><p>a < b and <3</p></article>", ["a < b and <3"]),
        ("", []),
        (None, []),
    ]
    for page, want in cases:
        assert lines(page) == want, page


def test_prefixes_nest():
    a, b = url_prefixes("http://H.x/en/1?p=2#t"), url_prefixes("https://h.x/en/1?p=3")
    assert a[:3] == b[:3] and a[3] != b[3] and len(a) == 4
    assert url_prefixes(None) == url_prefixes("") and url_prefixes("not a url") != url_prefixes(None)


def template(n, body):
    head = "<div><span>Site</span></div><div>Menu one</div><div>Menu two</div>"
    return f"<html><body>{head}<div>Today</div><div>{'</div><div>'.join(body)}</div><div>Bottom line</div><div>Read {n} more</div></body></html>"


def test_template_pages_are_parted_by_their_neighbours(spark):
    ready(spark)
    rows = [(i, f"http://t.x/news/{i}", template(i, [f"Story {i} begins.", "A line that all stories have in the middle.", f"It ends at {i}."])) for i in range(12)]
    rows += [(100, "http://alone.x/a", template(5, ["Only story."]))]
    got = {r["page_id"]: r for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    for i in range(12):
        assert got[i]["text"].split("\n") == [f"Story {i} begins.", f"It ends at {i}.", f"Read {i} more"] and got[i]["n_shared"] == 6
        assert got[i]["n_chars"] == len(got[i]["text"])
    assert got[100]["text"].startswith("Site\nMenu one") and got[100]["n_shared"] == 0


def test_articles_keep_paragraphs_that_others_have_too(spark):
    ready(spark)
    page = "<nav>Home</nav><p>Notice to all</p><article><h1>{0}</h1><p>Shared paragraph.</p></article>"
    rows = [(i, f"http://a.x/{i}", page.format(f"Title {i}")) for i in range(3)]
    got = {r["page_id"]: (r["text"], r["n_shared"]) for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: (f"Title {i}\nShared paragraph.", 2) for i in range(3)}


def test_odd_rows(spark):
    """Null pages and addresses, repeated rows, same pages, a long page, clashing columns."""
    ready(spark)
    long = "<article>" + "".join(f"<p>line {i}</p>" for i in range(20_000)) + "</article>"
    rows = [(None, None, None), (1, None, "<p>a"), (2, "x", "<p>b"), (2, "x", "<p>b"), (3, "http://h/1", "<p>same"), (4, "http://h/2", "<p>same"), (5, "http://l/", long), (6, "http://l/2", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("key", "lines", "text", "prefix", "deleted")})
    got = sorted(((r["page_id"], r["text"][:7], r["n_chars"]) for r in main_texts(pages).collect()), key=str)
    size = sum(len(f"line {i}\n") for i in range(20_000)) - 1
    assert got == sorted([(None, "", 0), (1, "a", 1), (2, "b", 1), (2, "b", 1), (3, "same", 4), (4, "same", 4), (5, "line 0\n", size), (6, "", 0)], key=str)


def test_empty_table(spark):
    ready(spark)
    assert main_texts(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []

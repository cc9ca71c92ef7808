"""Main text of web pages by nearest-URL page differencing.

A page is read into text lines, one for each block. Within a host it is paired with
the page nearest by URL path: one that shares the deepest path prefix (the smallest
page of that prefix; for this one itself, the largest). The lines of the two pages
are aligned by longest common subsequence, and the shared ones are deleted.

Markup says which lines are open to that. Menus, headers, footers, sidebars, notices,
adverts, forms and comments that it names go even where they differ from page to page;
only forms and frames (sidebars, headers and the like) stay where they are drawn around the
page's only container or heading, or around all its prose. Lines inside the container (<article> or <main>) stay where
another article has the same paragraph, but go where at least half of the pages of the
host share them with their nearest page (on hosts of LEAST_PAGES pages or more). On a
page without such a container every remaining line is open, and differencing alone
parts template and text.

Defined results. Null html gives an empty text, a null URL counts as an empty one.
Pages of the same lines, such as repeated rows, say nothing about each other: nothing
is deleted. Pages alone on their host lose nothing. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfeed.llm.common import rows_of, task, written

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)(?:>|\Z)|<(/?)([a-zA-Z][\w:-]*)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([\w:-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
ADDRESS = re.compile(r"^[a-zA-Z][\w+.-]*://([^/?#]*)([^?#]*)(.*)$", re.S)

# Elements by what they mean for text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
DROPPED = frozenset(
    "script style head title nav footer aside form button select option textarea input noscript template iframe svg canvas object audio "
    "video map menu dialog xmp noembed noframes".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Words in class or id that name a part outside the main text, whatever it holds ...
PART_WORDS = frozenset(
    "ad ads advert advertisement adsense adverts breadcrumb breadcrumbs comment comments consent cookie cookies disqus modal newsletter "
    "notice notices pager pagination popup promo promotion related replies reply respond share sharing signup sponsor sponsored subscribe".split()
)
# ... and frames of a page, which now and then are drawn around the story.
FRAME_WORDS = frozenset("banner footer login menu nav navbar navigation sidebar social toolbar widget".split())
PAGE_HEADERS = frozenset("header masthead topbar".split())
SCOPES = frozenset("article main section div td th li body table ul ol blockquote form aside nav header footer dd figure".split())


# Names that say how a part is shown, or that it is not there.
NEGATED = re.compile(
    r"(?:with|without|has|have|no|not|hide|is|show)[_-]\S*|\S*[_-](?:with|without|has|have|no|not)[_-]\S*"
    r"|\S*[_-](?:open|closed|on|off|enabled|disabled|free)"
)
HARD, SOFT = 2, 1  # dropped whatever it holds; dropped unless it holds the story


def dropped(tag: str, attributes: str, inside: bool) -> int:
    """Whether an element is no part of the main text: HARD, SOFT or 0; ``inside``: within an article."""
    if tag == "form":
        return SOFT
    if tag in DROPPED or tag == "header" and not inside:
        return HARD
    if not attributes or tag in ("html", "body", "main"):
        return 0
    soft = 0
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id"):
            words = {w for whole in value.split() if not NEGATED.fullmatch(whole) for w in re.split(r"[_-]+", whole)}
            if words & PART_WORDS:
                return HARD
            if tag != "article" and (words & FRAME_WORDS or not inside and words & PAGE_HEADERS):
                soft = SOFT
        elif name == "role" and value.strip() in DROPPED_ROLES:
            soft = SOFT
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return HARD
    return soft


def last_open(stack: list[tuple[str, tuple, str]], tag: str) -> int:
    index = len(stack) - 1
    while stack[index][0] != tag:
        index -= 1
    return index


def page_lines(page: str | None) -> list[tuple[str, bool, str]]:
    """(line, dropped by its markup, container: article, main or nothing) for each block in page order."""
    if not page:
        return []
    lines: list[tuple[str, int | None, str]] = []
    stack: list[tuple[str, int | None, str]] = []  # tag, innermost soft element around (0: none, None: dropped), container
    open_tags: Counter = Counter()
    parts: list[tuple[str, int | None]] = []  # text, innermost soft element around
    parents, headed = [0], set()  # of each soft element: the one around it; those with a heading of the page
    off, container = 0, ""
    at, size = 0, len(page)

    def flush() -> None:
        for around in sorted({a for _, a in parts}, key=lambda a: (a is not None, a or 0)):
            line = " ".join("".join(text for text, a in parts if a == around).split())
            if line:
                lines.append((line, around, container))
        parts.clear()

    def close(index: int) -> None:
        nonlocal off, container
        for tag, _, _ in stack[index:]:
            open_tags[tag] -= 1
        del stack[index:]
        off, container = (stack[-1][1], stack[-1][2]) if stack else (0, "")

    while at < size:
        found = TOKEN.search(page, at)
        if not found:
            parts.append((html.unescape(page[at:]), off))
            break
        if found.start() > at:
            parts.append((html.unescape(page[at : found.start()]), off))
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            if tag in BLOCK:
                flush()
            if open_tags[tag] > 0:
                close(last_open(stack, tag))
            continue
        if tag in BLOCK:
            flush()
            if open_tags["p"] > 0:  # a block ends an open paragraph of the same scope
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        close(i)
                        break
                    if stack[i][0] in SCOPES:
                        break
        if tag == "br":
            parts.append((" ", off))
        if tag in VOID:
            continue
        attributes = found[3] or found[6] or ""
        here, how = off, dropped(tag, attributes, container != "") if off is not None else 0
        if how == HARD:
            here = None
        elif how == SOFT:
            here = len(parents)
            parents.append(off)
        if tag == "h1" and here is not None:
            headed.add(here)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = end.start() if end else size
        elif attributes.endswith("/") and tag not in BLOCK:
            continue
        inner = container
        if tag == "article" or container != "article" and re.search(r"""itemprop\s*=\s*["']?articleBody""", attributes):
            inner = "article"
        elif not container and (tag == "main" or re.search(r"""role\s*=\s*["']?main\b""", attributes)):
            inner = "main"
        stack.append((tag, here, inner))
        open_tags[tag] += 1
        off, container = here, inner
    flush()
    wrappers = story_wrappers(lines, parents, headed)
    return [(line, around is None or around not in wrappers, container) for line, around, container in lines]


def prose(lines: Iterable[str]) -> int:
    """Characters in lines of ten words or more, which menus and labels seldom have."""
    return sum(len(line) for line in lines if line.count(" ") >= 9)


def story_wrappers(lines: list[tuple[str, int | None, str]], parents: list[int], headed: set[int]) -> set[int]:
    """Frames and forms to be kept, with 0 for no frame: those around the page's only container or heading, or all its prose."""
    seen = [x for x in lines if x[1] is not None]
    free = [x for x in seen if not x[1]]
    # Short pages have no prose; there every character counts.
    count = prose if prose(line for line, _, _ in seen) else lambda found: sum(map(len, found))
    if len(free) == len(seen) or count(line for line, _, container in free if container):
        return {0}
    within = [x for x in seen if x[1] and x[2]]
    beside = count(line for line, _, _ in free)
    if not within and beside and (0 in headed or not headed):
        return {0}
    only = within or [x for x in seen if x[1]]
    sizes = [0] * len(parents)
    for line, around, _ in only:
        sizes[around] += count([line])
    held = set(headed)
    for i in range(len(parents) - 1, 0, -1):  # an element comes after the one around it
        sizes[parents[i]] += sizes[i]
        if i in held:
            held.add(parents[i])
    total, out, here = sizes[0], {0}, 0
    if not within and not beside:
        held = set(range(len(parents)))  # all prose lies in frames
    while total:  # down to the innermost element that holds most of it
        inner = [i for i in range(here + 1, len(parents)) if parents[i] == here and 2 * sizes[i] > total and (within or i in held)]
        if not inner:
            break
        here = inner[0]
        out.add(here)
    return out


def settled(lines: list[tuple[str, bool, str]]) -> tuple[list[tuple[int, str]], list[int]]:
    """Lines that the markup leaves in the text, with their numbers; numbers of the lines that differencing may delete."""
    texts = {c: [text for text, off, container in lines if not off and container == c] for c in ("article", "main", "")}
    # The container with the most prose, the first of equal ones; of no container only where most of the prose is.
    named = [c for c in ("article", "main") if texts[c]]
    wanted = max(named, key=lambda c: prose(texts[c]), default="")
    if 2 * prose(texts[wanted]) < prose(texts[""]):
        wanted = ""
    kept = [(i, text) for i, (text, off, container) in enumerate(lines) if not off and (not wanted or container == wanted)]
    inside = {i for i, _ in kept} if wanted else set()
    return kept, [i for i in range(len(lines)) if i not in inside]


def url_prefixes(url: str | None) -> list[int]:
    """Hashes of the host, each longer path prefix and the whole URL, the shortest first."""
    found = ADDRESS.match(url or "")
    host, path, rest = (found[1].lower(), found[2], found[3]) if found else ("", url or "", "")
    digest = xxhash.xxh3_64(host.encode("utf-8", "surrogatepass"))
    hashes = [digest.intdigest()]
    for part in [x for x in path.split("/") if x] + [rest]:
        digest.update(b"/" + part.encode("utf-8", "surrogatepass"))
        hashes.append(digest.intdigest())
    return [h - (1 << 64) if h >> 63 else h for h in hashes]


TABLE_BITS = 1 << 28  # of rows that are kept to read an alignment off them; longer pages are halved first


class Places:
    """Where each line stands in a sequence, as the bits of an integer."""

    def __init__(self, lines: list[int]):
        self.at: dict[int, list[int]] = {}
        for j, line in enumerate(lines):
            self.at.setdefault(line, []).append(j)
        self.often: dict[int, int] = {}

    def bits(self, line: int) -> int:
        if line in self.often:
            return self.often[line]
        places = self.at.get(line, ())
        if len(places) < 64:
            return sum(1 << j for j in places)
        marks = bytearray(places[-1] // 8 + 1)
        for j in places:
            marks[j >> 3] |= 1 << (j & 7)
        return self.often.setdefault(line, int.from_bytes(marks, "little"))


def length_rows(own: list[int], other: list[int], keep: bool) -> list[int]:
    """Bit rows of the lengths of common subsequences, one for each line of ``own`` (or the last one): a 0 is one more.

    A row is made from the one before by an addition over whole integers.
    """
    places, full = Places(other), (1 << len(other)) - 1
    row, rows = full, []
    for line in own:
        met = row & places.bits(line)
        row = ((row + met) | (row - met)) & full
        if keep:
            rows.append(row)
    return rows if keep else [row]


def lengths_until(row: int, width: int) -> np.ndarray:
    """Length of the common subsequence for each prefix of the other sequence, from the row's zeros."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(width // 8 + 1, "little"), np.uint8), count=width, bitorder="little")
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common_lines(own: list[int], other: list[int]) -> list[int]:
    """Places in ``own`` of a longest common subsequence with ``other``.

    Equal ends are taken at once. Between them, lines that only one side has are left out, and the
    rest is aligned row by row; its rows are kept only up to TABLE_BITS, beyond which ``own`` is halved
    where the lengths from both ends add up best.
    """
    start = 0
    while start < min(len(own), len(other)) and own[start] == other[start]:
        start += 1
    end = 0
    while end < min(len(own), len(other)) - start and own[-1 - end] == other[-1 - end]:
        end += 1
    mine, theirs = own[start : len(own) - end], other[start : len(other) - end]
    both = set(mine) & set(theirs)
    at, theirs = [i for i, line in enumerate(mine) if line in both], [line for line in theirs if line in both]
    middle = [start + at[i] for i in aligned([mine[i] for i in at], theirs)] if at else []
    return [*range(start), *middle, *range(len(own) - end, len(own))]


def aligned(own: list[int], other: list[int]) -> list[int]:
    if not own or not other:
        return []
    if len(own) * len(other) > TABLE_BITS and len(own) > 1:
        half = len(own) // 2
        front = lengths_until(length_rows(own[:half], other, False)[0], len(other))
        back = lengths_until(length_rows(own[:half - 1 : -1], other[::-1], False)[0], len(other))
        cut = int((front + back[::-1]).argmax())
        return aligned(own[:half], other[:cut]) + [half + i for i in aligned(own[half:], other[cut:])]
    rows, found = length_rows(own, other, True), []
    i, j = len(own) - 1, len(other) - 1
    while i >= 0 and j >= 0:
        if own[i] == other[j]:
            found.append(i)
            i, j = i - 1, j - 1
        elif rows[i] >> j & 1:  # no longer with this line of the other than without it
            j -= 1
        else:
            i -= 1
    return found[::-1]


SIGNS = pa.schema([("key", pa.binary()), ("prefixes", pa.list_(pa.int64())), ("whole", pa.int64()), ("numbers", pa.list_(pa.int32())), ("hashes", pa.list_(pa.int64())), ("inside_numbers", pa.list_(pa.int32())), ("inside", pa.list_(pa.int64()))])
SIGNS_DDL = "key binary, prefixes array<long>, whole long, numbers array<int>, hashes array<long>, inside_numbers array<int>, inside array<long>"
LEAST_PAGES = 8  # of a host, before a line can be told to be on most of them
TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("key", pa.binary()), ("lines", pa.list_(pa.struct([("n", pa.int32()), ("text", pa.string())])))])


def _signed(line: str) -> int:
    value = xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def _signs(batch: dict) -> dict:
    whole, numbers, hashes, inside_numbers, inside = [], [], [], [], []
    for page in batch["html"]:
        lines = page_lines(page.as_py())
        kept, open_lines = settled(lines)
        may_go = set(open_lines)
        held = [i for i, _ in kept if i not in may_go]
        whole.append(_signed("\n".join(line for line, _, _ in lines)))
        numbers.append(open_lines)
        hashes.append([_signed(lines[i][0]) for i in open_lines])
        inside_numbers.append(held)
        inside.append([_signed(lines[i][0]) for i in held])
    prefixes = [url_prefixes(u.as_py()) for u in batch["url"]]
    return {"key": batch["key"], "prefixes": prefixes, "whole": whole, "numbers": numbers, "hashes": hashes, "inside_numbers": inside_numbers, "inside": inside}


def _texts(batch: dict) -> dict:
    lines = [[{"n": n, "text": text} for n, text in settled(page_lines(page.as_py()))[0]] for page in batch["html"]]
    return {"page_id": batch["page_id"], "url": batch["url"], "key": batch["key"], "lines": lines}


def _deleted(batch: dict) -> dict:
    out, shared = [], []
    columns = (batch[n].to_pylist() for n in ("whole", "numbers", "hashes", "inside_numbers", "inside", "other_whole", "other", "other_inside"))
    for whole, numbers, own, inside_numbers, inside, other_whole, other, other_inside in zip(*columns):
        same = whole == other_whole
        out.append([] if same else [numbers[i] for i in common_lines(own, other)])
        shared.append([] if same else [{"n": inside_numbers[i], "hash": inside[i]} for i in common_lines(inside, other_inside)])
    return {"key": batch["key"], "host": batch["host"], "deleted": out, "shared": shared}


DELETED = pa.schema([
    ("key", pa.binary()), ("host", pa.int64()), ("deleted", pa.list_(pa.int32())), ("shared", pa.list_(pa.struct([("n", pa.int32()), ("hash", pa.int64())]))),
])


def shared_lines(pages: DataFrame) -> DataFrame:
    """key, deleted: the lines each page shares with its nearest page. Hashes travel, no texts.

    A line inside the container goes only if most pages of its host share it so.
    """
    signs = pages.mapInArrow(task(rows_of(_signs, SIGNS)), SIGNS_DDL)
    signs = written(signs.dropDuplicates(["key"]), "page-lines")
    steps = signs.select("key", F.posexplode("prefixes").alias("depth", "prefix"))
    ends = steps.groupBy("prefix").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high")
    ends = written(ends, "prefix-ends")  # a join of two plain inputs is split where a host is large
    partner = F.when(F.col("key") == F.col("low"), F.col("high")).otherwise(F.col("low"))
    nearest = steps.join(ends, "prefix").groupBy("key").agg(F.max(F.struct("depth", partner.alias("partner"))).alias("nearest"))
    pairs = nearest.select("key", F.col("nearest.partner").alias("partner"))
    others = signs.select(F.col("key").alias("partner"), F.col("whole").alias("other_whole"), F.col("hashes").alias("other"), F.col("inside").alias("other_inside"))
    host = F.col("prefixes")[0].alias("host")
    pairs = pairs.join(others, "partner").join(signs.select("key", host, "whole", "numbers", "hashes", "inside_numbers", "inside"), "key").drop("partner")
    ddl = "key binary, host long, deleted array<int>, shared array<struct<n:int,hash:long>>"
    found = pairs.mapInArrow(task(rows_of(_deleted, DELETED)), ddl)
    found = written(found.where((F.size("deleted") > 0) | (F.size("shared") > 0)), "shared-lines")
    seen = found.select("host", F.explode(F.array_distinct("shared.hash")).alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("n"))
    pages_of = signs.groupBy(host).agg(F.count("*").alias("pages")).where(F.col("pages") >= LEAST_PAGES)
    common = seen.join(pages_of, "host").where("2 * n >= pages").groupBy("host").agg(F.collect_list("hash").alias("common"))
    common = written(common, "common-lines")
    inside = F.filter("shared", lambda line: F.array_contains(F.col("common"), line["hash"]))
    gone = F.when(F.col("common").isNull(), F.col("deleted")).otherwise(F.concat("deleted", F.transform(inside, lambda line: line["n"])))
    return found.join(common, "host", "left").select("key", gone.alias("deleted")).where(F.size("deleted") > 0)


def main_texts(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, n_shared (lines that differencing deleted) for every page."""
    source = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    empty = F.lit("")
    keyed = source.withColumn("key", F.unhex(F.md5(F.concat(F.coalesce("url", empty), F.lit("\n"), F.coalesce("html", empty)))))
    texts = keyed.mapInArrow(task(rows_of(_texts, TEXTS)), "page_id long, url string, key binary, lines array<struct<n:int,text:string>>")
    joined = texts.join(shared_lines(keyed.select("key", "url", "html")), "key", "left")
    gone = F.coalesce("deleted", F.array().cast("array<int>"))
    kept = F.filter("lines", lambda line: ~F.array_contains(gone, line["n"]))
    text = F.array_join(F.transform(kept, lambda line: line["text"]), "\n")
    answer = joined.select("page_id", "url", text.alias("text"), F.size(gone).alias("n_shared"))
    return answer.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared")

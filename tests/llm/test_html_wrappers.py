"""Wrappers whose names or tags would drop the whole story."""

import pytest

from adfeed.llm.html import page_lines, settled

STORY = ["A long paragraph that tells the story in more than ten plain words.", "It goes on here with a second paragraph of more than ten words."]
BODY = "".join(f"<p>{p}</p>" for p in STORY)


def lines(page):
    return [text for _, text in settled(page_lines(page))[0]]


@pytest.mark.parametrize("start, end", [
    ("<form action=x>", "</form>"), ("<div class='content with-sidebar'>", "</div>"), ("<div class=no-comments>", "</div>"),
    ("<div class='has-banner'>", "</div>"), ("<div id=social-history>", "</div>"), ("<form><div class='social-history'>", "</div></form>"),
])
def test_wrappers_keep_the_story(start, end):
    for inner in (f"<article>{BODY}</article>", f"<main>{BODY}</main>", f"<div>{BODY}</div>"):
        assert lines(f"<nav>menu</nav>{start}{inner}<div class=sidebar>side</div>{end}<footer>foot</footer>") == STORY, (start, inner)


def test_comments_and_small_parts_still_go():
    comments = "<div class=comments>" + "<article><p>A comment of some reader in ten words or a little more.</p></article>" + "</div>"
    assert lines(f"<article>{BODY}</article>{comments}<form>Search</form>") == STORY
    assert lines(f"<div>{BODY}</div><div class=newsletter><p>Read our newsletter with ten words and some more of them today.</p></div>") == STORY


def test_a_teaser_does_not_discard_the_story():
    assert lines(f"<main>{BODY}<article><p>Read next.</p></article></main>") == STORY
    assert lines(f"<div>{BODY}</div><article><p>Read next.</p></article>")[:2] == STORY

import random
import re

from pyspark.sql import functions as F

from adfeed.functions.text import (
    as_export_text, body_documents, clean_text, html_json_blobs, is_permalink, java_pattern, mask_credentials, strip,
)

ODD = [chr(c) for c in (0x20, 0x09, 0x0A, 0x0B, 0x1C, 0x1F, 0x85, 0xA0, 0x2003, 0x2028, 0x3000, 0x200B)]


def test_clean_text_cases(evaluate):
    values = ["voir https://a.b/c?d=1 ici", "a  b\n\n c\t", None, "", "   ", "HTTP://reste.la", "x\u00a0\x1cy"]
    assert evaluate(clean_text, values) == ["voir ici", "a b c", "", "", "", "HTTP://reste.la", "x y"]


def test_every_odd_space_counts_as_space(evaluate):
    """All but the zero-width space, which is none."""
    spaces = [c for c in ODD if c != chr(0x200B)]
    assert evaluate(clean_text, [f"{c}a{c}{c}b{c}" for c in spaces]) == ["a b"] * len(spaces)
    assert evaluate(clean_text, [f"x http://a{c}b" for c in spaces]) == ["x b"] * len(spaces)
    assert evaluate(clean_text, ["a\u200bb", "voir https://x\u200by z", "http://", "https://é👍 fin", "xhttps://a b", "://a"]) == [
        "a\u200bb", "voir z", "http://", "fin", "x b", "://a"]


def test_cleaning_leaves_no_address_and_no_double_space(evaluate):
    draw = random.Random(1)
    parts = ODD + ["http://a", "https://", "é", "texte", "👍", "://", "."]
    values = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(1500)]
    once = evaluate(clean_text, values)
    assert evaluate(clean_text, [o for o in once if "http" not in o]) == [o for o in once if "http" not in o]
    for value, cleaned in zip(values, once):
        assert cleaned == cleaned.strip() and not re.search(r"\s\s|[^\S ]", cleaned)
        if "http" not in value:  # without addresses only white space goes
            assert cleaned.replace(" ", "") == re.sub(r"\s", "", value)
    assert evaluate(strip, values) == [v.strip() for v in values]


def test_word_boundaries_are_those_of_unicode_text(evaluate):
    pattern = r"\b(prix|à\s+vendre|c[ée]der)\b"
    draw = random.Random(2)
    parts = ["prix", "à vendre", "À\u00a0VENDRE", "céder", "x", "é", "_", "2", "²", " ", "-", "\ufe0f", "☎", "́", "ß"]
    values = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 5))) for _ in range(1500)]
    found = evaluate(lambda c: c.rlike(java_pattern(pattern)), values)
    assert found == [re.search(pattern, v, re.I) is not None for v in values]


def test_permalinks_and_credentials(evaluate):
    urls = ["https://x/groups/1/posts/2", "https://x/permalink/9", "https://x/moi", None]
    assert evaluate(is_permalink, urls) == [True, True, False, False]
    texts = ["postgresql://u:p@h/b", "sans rien", "a://b:c@d et e://f:g:h@i"]
    assert evaluate(mask_credentials, texts) == ["postgresql://u:***@h/b", "sans rien", "a://b:***@d et e://f:***@i"]


def test_json_scripts_of_a_page(evaluate):
    page = (
        '<script type="application/json">{"a":\n1}</script><script>x</script>'
        '<script id="1" type="application/json">non</script><script type="application/json" nonce="n">2</script>'
    )
    assert evaluate(html_json_blobs, [page, "", None]) == [['{"a":\n1}', "2"], [], None]


def test_documents_of_a_body(evaluate):
    bodies = ['for (;;);{"a":1}', 'for (;;);for (;;);1', '{"a":1}\r\n\n {"b":2}\u2028x', None, " \n "]
    got = evaluate(body_documents, bodies)
    assert got[0] == ['{"a":1}']
    assert got[1] == ["for (;;);1"]
    assert got[2] == ['{"a":1}\r\n\n {"b":2}\u2028x', '{"a":1}', '{"b":2}', "x"]
    assert got[3] == got[4] == []


def test_export_text(spark):
    df = spark.sql("SELECT array('a', NULL) l, CAST(NULL AS ARRAY<STRING>) n, true b, 5L i, CAST(NULL AS STRING) s, TIMESTAMP'2026-01-02 03:04:05' t")
    types = dict(df.dtypes)
    row = df.select(*[as_export_text(F.col(c), types[c]).alias(c) for c in df.columns]).first()
    assert list(row) == ["a; None", "", "True", "5", "", "2026-01-02T03:04:05+00:00"]

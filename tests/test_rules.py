import random

from pyspark.sql import functions as F

from adfeed.functions.rules import LAND_RULES, RuleSet, folded, found, is_candidate, reject_reason, rental_tag, stems
from adfeed.functions.text import matches
from adfeed.operators.filtering import candidates, funnel, reject_breakdown, rejects, tag_posts
from adfeed.queries.base import TEST_RULES
from adfeed.session import spread


CASES = [
    ("Vente d'une parcelle de 400 m2 à Karpala, PUH, prix : 9 500 000", True),
    ("Je recherche un terrain vers Pissy, merci", False),
    ("Qui a un terrain à vendre à Saaba ?", True),
    ("Parcelle : cliquez ici pour gagner", False),
    ("Bonne fête à tous les membres", False),
    ("", False), ("  \u00a0 ", False), (None, False),
    ("Un bien de 600m2, appelez", True), ("Un bien de 5ha, appelez", True), ("Un bien de 300m², appelez", True),
    ("deux parcelles, trois terrains", False), ("dix hectares", True), ("600m25", False),
    ("terrain \u6295\u8d44", False), ("NÉGOCIABLE", True), ("permis d\u2019habiter", False), ("permis d'habiter", True),
    ("suis preneur d'un terrain, prix 5", True), ("besoin d'une parcelle", False),
]
WORDS = ["terrain", "parcelle", "titre foncier", "PUH", "attestation", "superficie", "hectare"]


def test_cases(evaluate):
    texts = [t for t, _ in CASES] + [f"Bonjour, un bien avec {w} disponible" for w in WORDS]
    assert evaluate(is_candidate, texts) == [e for _, e in CASES] + [True] * len(WORDS)


# Parts by what they are for the land rules; joined by commas they stay what they are.
WANTED = ["terrain", "Parcelle", "céder", "CÉDER", "titre  foncier", "600 m2", "5ha.", "300m²"]
REQUESTS = ["je recherche", "cherche une", "qui a un terrain à proposer", "besoin d'une"]
SALES = ["à vendre", "A VENDRE", "vends", "prix : 5"]
SPAM = ["cliquez ici", "gagnez 5", "forex trading"]
NOTHING = ["bonjour", "é", "_", "2", "zones", "lotissements", "\u00a0", "parcelles", "terrains"]


def test_each_kind_of_part_decides_as_it_should(evaluate):
    """Spam ends it; without a wanted word nothing counts; a request loses to a sale."""
    draw = random.Random(3)
    texts, expected = [], []
    for _ in range(1500):
        kinds = [draw.sample(kind, draw.choice([0, 0, 1, 2])) for kind in (WANTED, REQUESTS, SALES, SPAM, NOTHING)]
        wanted, requests, sales, spam, _ = kinds
        parts = sum(kinds, [])
        draw.shuffle(parts)
        texts.append(", ".join(parts))
        # A request or a sale names land itself in some of the phrases.
        named = wanted or "qui a un terrain à proposer" in requests or set(sales) - {"vends"}
        expected.append(bool(named and not spam and (sales or not requests)))
    assert evaluate(is_candidate, texts) == expected
    assert 200 < sum(expected) < 1300


def test_another_rule_set(evaluate):
    texts = ["avec", "avec dans", "avec dans est", "avec ###", "dans est", "12 de", "12 de5", "hath that  the", "hath that the 1234", "rien"]
    assert evaluate(lambda c: is_candidate(c, TEST_RULES), texts) == [True, False, True, False, False, True, False, False, True, False]


def test_reasons_and_rental(evaluate):
    assert evaluate(reject_reason, ["", "rien", "terrain"]) == ["texte_vide", "regex_niveau1", None]
    assert evaluate(rental_tag, ["maison à LOUER", "louera", "Bail", None]) == [True, False, True, False]


def posts(spark):
    sale = "A vendre parcelle 500 m2, attestation"
    rows = [
        (0, "g1", sale), (1, "g1", "Je recherche un terrain"), (2, "g2", "cliquez ici"), (3, "g2", sale + " https://x.y"),
        (4, "g2", None), (5, "g1", " https://a.b "), (6, "g1", "terrain 2"), (7, "g2", sale),
    ]
    return spark.createDataFrame(rows, "pos INT, groupe_id STRING, texte STRING")


def test_split_keeps_every_post(spark):
    tagged = tag_posts(posts(spark))
    kept = candidates(tagged, ["pos"])
    assert sorted(r["pos"] for r in kept.collect()) == [0, 6]
    assert {(r["pos"], r["motif_rejet"]) for r in rejects(tagged).collect()} == {
        (1, "regex_niveau1"), (2, "regex_niveau1"), (4, "texte_vide"), (5, "texte_vide"),
    }
    counts = {tuple(r) for r in reject_breakdown(rejects(tagged), ["groupe_id"]).collect()}
    assert counts == {("regex_niveau1", "g1", 1), ("regex_niveau1", "g2", 1), ("texte_vide", "g1", 1), ("texte_vide", "g2", 1)}


def test_funnel_adds_up(spark):
    tagged = tag_posts(posts(spark))
    valid = candidates(tagged, ["pos"]).filter("pos = 0")
    rows = {r["groupe_id"]: r for r in funnel(tagged, ["groupe_id"], ["pos"], valid).collect()}
    assert [rows["g1"][c] for c in ("nb_bruts", "nb_rejetes", "nb_candidats", "nb_doublons", "nb_valides")] == [4, 2, 2, 0, 1]
    assert [rows["g2"][c] for c in ("nb_bruts", "nb_rejetes", "nb_candidats", "nb_doublons", "nb_valides")] == [4, 2, 0, 2, 0]
    for r in rows.values():
        assert r["nb_bruts"] == r["nb_rejetes"] + r["nb_candidats"] + r["nb_doublons"]
    assert funnel(tagged.filter("false"), ["groupe_id"], ["pos"]).count() == 0
    total = funnel(tagged.withColumn("t", F.lit(1)), ["t"], ["pos"]).first()
    assert total["nb_candidats"] == 2 and total["pct_candidats"] == 25.0


def test_stems_are_what_a_match_cannot_do_without():
    assert stems(LAND_RULES.spam) == ("cliquez", "gagnez", "gratuit", "trading", "投资")
    assert stems(LAND_RULES.numeric) == ("ha", "m2", "m²")
    assert "négociable" in stems(LAND_RULES.include) and "negociable" in stems(LAND_RULES.include)
    assert stems(r"abc|\d+") is None and stems(r"a?b?") is None and stems(r"(abc)*xy") == ("xy",) and stems(r"ab{2,}cd") == ("cd",)
    assert stems(r"(?:one|two)\s+three") == ("three",) and stems("x") is None


def test_gate_agrees_with_the_pattern_alone(evaluate):
    """Also for letters that only the pattern takes for the same."""
    draw = random.Random(9)
    parts = ["PRIX", "prıx", "prİx", "ſuperficie", "PAR", "celle", "TERRAIN", "hectareſ", "NÉGOCIABLE", "Ha", "5", "5 Ha", "M2", "m²", "à", "vendre", "ΣΑΣ", "Ångstrom", "K", " ", "投资", "d'", "habiter", "permiſ"]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 6))) for _ in range(600)] + [None, ""]
    for rules in (LAND_RULES, TEST_RULES, RuleSet("kå|ångstrom", r"\d\s*kg", "sas", "abc|prix", "zz|ſs")):
        for pattern in (rules.include, rules.numeric, rules.request, rules.override, rules.spam):
            gated = evaluate(lambda c: found(c, folded(c), pattern), texts)
            assert gated == evaluate(lambda c: matches(c, pattern), texts), pattern


def test_only_small_inputs_are_spread(spark):
    small = spark.range(10)
    assert "Exchange" in spread(small)._jdf.queryExecution().executedPlan().toString()
    large = spark.range(10**12)
    assert spread(large) is large

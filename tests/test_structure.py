import json
import sys

import pytest
from pyspark import cloudpickle

from adfeed.functions.extract import area_m2, contacts, first_named, first_sentence, price, rule_extract
from adfeed.functions.model_output import validate_output
from adfeed.operators.structure import (
    Permanent, RateLimited, Transient, call_extractor, invalid_posts, route, structure, valid_ads,
)

# The workers do not import test modules: the extractor below travels whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FULL = {
    "est_une_annonce_valide": True, "type_bien": "parcelle", "quartier_zone": "karpala", "superficie_m2": 300, "prix_fcfa": 7_500_000,
    "statut_document": "puh", "contacts_whatsapp": ["70 00 00 00"], "mots_cles_pertinents": [], "resume_court": "Une parcelle.",
}


def answer(**changes):
    merged = {**FULL, **changes}
    return json.dumps({k: v for k, v in merged.items() if v is not ...})


# answer -> accepted when lenient, accepted when strict
ANSWERS = [
    (answer(), True, True), (answer(inconnu=[1]), True, True), ('{"est_une_annonce_valide": true, "type_bien": "x"}', True, True),
    ("", False, False), (None, False, False), ("pas du json", False, False), ("[]", False, False), ("true", False, False),
    (answer(est_une_annonce_valide=...), False, False), (answer(type_bien=...), False, False), (answer(type_bien=None), False, False),
    (answer(est_une_annonce_valide=None), False, False), (answer(est_une_annonce_valide="peut-être"), False, False),
    (answer(est_une_annonce_valide="yes"), True, False), (answer(est_une_annonce_valide=1), True, False), (answer(est_une_annonce_valide=2), False, False),
    (answer(type_bien=5), False, False), (answer(prix_fcfa=None, quartier_zone=None), True, True), (answer(prix_fcfa=600.0), True, True),
    (answer(prix_fcfa=600.5), False, False), (answer(prix_fcfa="600"), True, False), (answer(prix_fcfa=" 1_000 "), True, False),
    (answer(prix_fcfa="six"), False, False), (answer(prix_fcfa=True), True, False), (answer(prix_fcfa=[1]), False, False),
    (answer(prix_fcfa=3_000_000_000), True, True), (answer(prix_fcfa=10**25), False, False), (answer(prix_fcfa=1e3), True, True),
    (answer(quartier_zone=5), False, False), (answer(contacts_whatsapp=None), False, False), (answer(contacts_whatsapp=[5]), False, False),
    (answer(contacts_whatsapp=[None]), False, False), (answer(contacts_whatsapp=["x", None]), False, False), (answer(contacts_whatsapp=[]), True, True),
    (answer(contacts_whatsapp="70"), False, False), (answer(resume_court=None), False, False), (answer(resume_court=...), True, True),
]


@pytest.mark.parametrize("strict", [False, True])
def test_contract(evaluate, strict):
    got = evaluate(lambda c: validate_output(c, strict).isNotNull(), [a for a, _, _ in ANSWERS])
    assert got == [(s if strict else lenient) for _, lenient, s in ANSWERS]


def test_values(evaluate):
    texts = [answer(prix_fcfa=-5, superficie_m2=0), answer(prix_fcfa=3_000_000_000, superficie_m2="+1_0.0"), '{"est_une_annonce_valide": 0, "type_bien": "x"}']
    first, second, third = evaluate(validate_output, texts)
    assert (first["prix_fcfa"], first["superficie_m2"], first["contacts_whatsapp"]) == (None, 0, ["70 00 00 00"])
    assert (second["prix_fcfa"], second["superficie_m2"]) == (3_000_000_000, 10)
    assert (third["est_une_annonce_valide"], third["contacts_whatsapp"], third["resume_court"], third["prix_fcfa"]) == (False, [], "", None)


def test_tries_and_waits():
    def faults(*kinds):
        left = list(kinds)

        def extractor(text):
            if left:
                raise left.pop(0)
            return "{}"
        return extractor

    waits = []
    assert call_extractor("t", faults(Transient(), Transient()), sleep=waits.append) == "{}"
    assert waits == [2.0, 4.0]
    waits.clear()
    assert call_extractor("t", faults(RateLimited()), sleep=waits.append) == "{}"
    assert 2.0 <= waits[0] <= 3.0
    assert call_extractor("t", faults(*[Transient()] * 3), sleep=waits.append) is None
    waits.clear()
    assert call_extractor("t", faults(Permanent()), sleep=waits.append) is None and waits == []
    assert call_extractor("t", lambda t: "", sleep=waits.append) is None
    assert call_extractor("t", lambda t: None, sleep=waits.append) is None
    with pytest.raises(ZeroDivisionError):
        call_extractor("t", faults(ZeroDivisionError()), sleep=waits.append)


def by_first_word(text):
    word = text.split()[0]
    if word == "panne":
        raise Transient()
    if word == "refus":
        raise Permanent()
    return {
        "ok": answer(), "non": answer(est_une_annonce_valide=False), "mal": answer(est_une_annonce_valide="?"), "vide": "", "tordu": "{",
    }[word]


@pytest.mark.parametrize("in_flight", [2, 9])
def test_routes(spark, in_flight):
    words = ["ok", "non", "mal", "vide", "tordu", "panne", "refus"]
    df = spark.createDataFrame([(w, f"{w} texte", "x") for w in words], "id STRING, texte_nettoye STRING, resume_court STRING")
    answered = structure(df, by_first_word, in_flight=in_flight, sleep=lambda s: None)
    rows = {r["id"]: r for r in route(answered).collect()}
    assert {w: rows[w]["motif_rejet"] for w in words} == {
        "ok": None, "non": "llm_juge_invalide", **dict.fromkeys(words[2:], "echec_api_ou_validation"),
    }
    assert (rows["ok"]["quartier_zone"], rows["ok"]["statut_document"], rows["ok"]["resume_court"]) == ("Karpala", "PUH", "Une parcelle.")
    assert rows["non"]["quartier_zone"] == "karpala" and rows["panne"]["type_bien"] is None
    routed = route(answered)
    assert valid_ads(routed).count() == 1 and invalid_posts(routed).count() == 6


def test_no_candidates(spark):
    df = spark.createDataFrame([], "id STRING, texte_nettoye STRING")
    assert route(structure(df, by_first_word)).count() == 0


def test_amounts(evaluate):
    texts = ["600m2", "2,5 ha", "1 ha soit 10000 m²", "600 m2 et 700 m2", "5 habitants", "0,00001 ha", "3 hectares", None]
    assert evaluate(area_m2, texts) == [600, 25_000, 10_000, None, None, None, 30_000, None]
    texts = ["15 000 000 FCFA", "7.500.000 f cfa", "prix 5000", "100 CFA ou 200 CFA", "100 cfa, 100 FCFA", "10 cfao", None]
    assert evaluate(price, texts) == [15_000_000, 7_500_000, None, None, 100, None, None]


def test_contacts(evaluate):
    texts = ["tel +226 70-12-34-56 ou 70123456, 70123456", "prix 15 000 000 FCFA", "ip 10.20.30.40", "15 000 000", "id 12345678901234567890", None]
    assert evaluate(contacts, texts) == [["+226 70-12-34-56", "70123456"], [], [], [], [], None]


def test_vocabulary_scan(evaluate):
    vocab = ["Attestation", "Attestation d'attribution"]
    texts = ["une ATTESTATION D'attribution", "attestation", "attestations", None]
    assert evaluate(lambda c: first_named(c, vocab), texts) == ["Attestation d'attribution", "Attestation", None, None]
    assert evaluate(lambda c: first_sentence(c, 3), ["un deux trois quatre. cinq", "a! b"]) == ["un deux trois", "a!"]


def test_rules_fill_the_contract(evaluate):
    text = "A vendre villa 400 m2 à Karpala, PUH, 9 000 000 FCFA, tel 70 11 22 33"
    read = evaluate(lambda c: validate_output(rule_extract(c), strict=True), [text, "villa"])
    assert read[0].asDict() == {
        "est_une_annonce_valide": True, "type_bien": "villa", "quartier_zone": "Karpala", "superficie_m2": 400, "prix_fcfa": 9_000_000,
        "statut_document": "PUH", "contacts_whatsapp": ["70 11 22 33"], "mots_cles_pertinents": ["a vendre", "puh"], "resume_court": text,
    }
    assert read[1]["est_une_annonce_valide"] is False and read[1]["prix_fcfa"] is None

"""The threat grammar: announced acts with an object, in one language; and the weight learned for it."""

import pytest

from tidelog.llm import toxicity

MODEL = toxicity.Toxicity({"idiot$": 4.0}, (-3.0, 1.0, 2.0, 1.0))


def total(text):
    return sum(s for _, _, s in MODEL.clauses(text))


@pytest.mark.parametrize(
    "text", ["I will kill you", "you will die", "we are going to hurt you", "ich werde dich töten", "je vais te tuer", "te voy a matar", "te mataré", "I will find and kill you"]
)
def test_threats(text):
    assert total(text) > 0 and MODEL.has_threat(text)


@pytest.mark.parametrize(
    "text",
    [
        "Sie kauft die Zeitung.",
        "Ich will dir die Zeitung geben.",
        "Sie werden die Stadt sehen.",
        "your cat can burn calories",
        "you kill time",
        "will you come? they kill time",
        "the fire will destroy the house",
        "",
    ],
)
def test_no_threats(text):
    assert total(text) == 0 and not MODEL.has_threat(text)


def test_negation_report_and_clauses():
    assert 0 < total("I will not kill you") < total("I will kill you")
    assert total("he said: I will kill you") < total("I will kill you")
    assert total("not now, you idiot") == total("you idiot") == total("not now but you idiot")
    assert [c[:2] for c in MODEL.clauses("Fine, you idiot, fine")] == [(5, 15)]


def test_weight_from_labels():
    assert toxicity.threat_weight({(0, False): 90, (1, False): 10}) == toxicity.THREAT_WEIGHT
    assert toxicity.threat_weight({(0, False): 90, (1, False): 10, (1, True): 50}) > 1
    assert toxicity.threat_weight({(0, False): 90, (1, False): 10, (0, True): 500}) == 0

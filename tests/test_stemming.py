import random

from corpusloom.functions.stemming import STEP_2, STEP_3, STEP_4, porter_stem, stem_prefix
from corpusloom.operators.analysis import ENGLISH, STANDARD, analyze, analyze_text

# Examples of the 1980 paper.
PAPER = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
    "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size",
    "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz",
    "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat",
    "conditional": "condit", "rational": "ration", "digitizer": "digit", "radically": "radic",
    "differently": "differ", "vietnamization": "vietnam", "predication": "predic",
    "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope",
    "formality": "formal", "sensibility": "sensibl", "triplicate": "triplic",
    "formative": "form", "formalize": "formal", "electrical": "electr", "goodness": "good",
    "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin",
    "adjustable": "adjust", "defensible": "defens", "irritant": "irrit",
    "replacement": "replac", "adjustment": "adjust", "dependent": "depend",
    "adoption": "adopt", "communism": "commun", "activate": "activ", "effective": "effect",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "generalizations": "gener", "oscillators": "oscil",
}


def test_paper_examples():
    assert {w: porter_stem(w) for w in PAPER} == PAPER


def test_query_and_document_forms_meet():
    assert porter_stem("install") == porter_stem("installation") == porter_stem("installing")
    assert porter_stem("users") == porter_stem("user")


def test_analyzers(column):
    text = "The User's GUIDES_2 to naïve  foo-bar’s 3.5!"
    assert column(lambda c: analyze(c, STANDARD), [text, None]) == [
        ["the", "user", "s", "guides_2", "to", "naïve", "foo", "bar", "s", "3", "5"], [],
    ]
    english = ["user", "guides_2", "naïv", "foo", "bar", "3", "5"]
    assert column(lambda c: analyze(c, ENGLISH), [text]) == [english]


def test_driver_and_column_analysis_agree(spark, column):
    texts = ["The dog's runs", "it's his’s class's", "", "Überraschung and the end"]
    for analyzer in (STANDARD, ENGLISH):
        by_column = column(lambda c: analyze(c, analyzer), texts)
        assert [analyze_text(spark, t, analyzer) for t in texts] == by_column


def test_words_begin_like_their_stem():
    rng = random.Random(9)
    ends = [*STEP_2, *STEP_3, *STEP_4, "s", "es", "ies", "sses", "ed", "eed", "ing", "y", "e", "bility", "ability", "ll", ""]
    for _ in range(200_000):
        word = "".join(rng.choice("abeilotsy") for _ in range(rng.randrange(0, 6)))
        word += "".join(rng.choice(ends) for _ in range(rng.randrange(0, 4)))
        if word:
            assert word.startswith(stem_prefix(porter_stem(word))), word

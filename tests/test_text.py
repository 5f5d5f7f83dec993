import json
import random

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from commwatch.functions.stopwords import BASE, ENGLISH
from commwatch.functions.text import counts_json, token_counts, tokens, total_tokens


def counts(rows, texts, reset):
    frame = rows(texts, "text").select(
        "text", token_counts(tokens("text"), reset).alias("c")
    )
    return {r.text: {c.token: c.n for c in r.c} for r in frame.collect()}


COUNT_RULES = [
    ("deal deal deal", {"deal": 3}, {"deal": 3}),
    ("Deal deal deal", {"deal": 3}, {"deal": 3}),
    ("deal deal Deal", {"deal": 3}, {"deal": 1}),
    ("deal Deal deal", {"deal": 3}, {"deal": 2}),
    ("the The", {"the": 1}, {"the": 1}),
    ("a_b x/y ok", {"ok": 1}, {"ok": 1}),
    ("", {}, {}),
    (None, {}, {}),
    ("zz Aa zz aa Zz", {"zz": 3, "aa": 2}, {"zz": 1, "aa": 2}),
    ("DEAL deal DEAL deal deal", {"deal": 5}, {"deal": 3}),
]


@pytest.mark.parametrize("reset", [False, True])
def test_count_rules(rows, reset):
    expected = {text: by_reset if reset else clean for text, clean, by_reset in COUNT_RULES}
    assert counts(rows, list(expected), reset) == expected


def model(words):
    found = {}
    for word in words:
        folded = word.lower()
        found[folded] = found[folded] + 1 if word in found else 1
    return found


def test_reset_rule_against_a_model(rows):
    rng = random.Random(7)
    vocabulary = ["gas", "Gas", "GAS", "oil", "Oil", "ship", "Zed", "zed", "öl", "Öl"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 40))) for _ in range(300)]
    got = counts(rows, texts, True)
    assert got == {t: model(t.split()) for t in texts}


def test_tokens_as_written(rows):
    text = (
        "The trade's write-off: a--b e.g. café I x don't Don't " + "y" * 30 + " " + "z" * 31
        + " a~b p#q C\\D mail@example.com 3,000"
    )
    frame = rows([text], "text").select(tokens("text").alias("t"))
    assert frame.collect()[0].t == [
        "The", "trade's", "write-off", "e.g", "café", "Don't", "y" * 30, "mail",
        "example.com", "000",
    ]


def test_marks_anywhere_drop_the_whole_token(rows):
    text = "ab-/cd ef.~gh ij/ /kl mn'#op qr_st-uv ab.cd-ef gas. 'oil' x1-y2 wx-(yz"
    frame = rows([text], "text").select(tokens("text").alias("t"))
    assert frame.collect()[0].t == ["ab.cd-ef", "gas", "oil", "x1-y2", "wx", "yz"]


def test_a_long_chain_of_word_parts_takes_no_stack(rows):
    chain = "ab." * 100_000 + "ab"
    frame = rows([f"gas {chain} oil {chain}/x deal"], "text").select(tokens("text").alias("t"))
    assert frame.collect()[0].t == ["gas", "oil", "deal"]


def test_stop_words_are_those_of_spark(spark):
    assert set(ENGLISH) == set(StopWordsRemover.loadDefaultStopWords("english"))
    assert set(BASE) < set(ENGLISH)
    assert len(ENGLISH) == len(set(ENGLISH))


def test_stop_words_are_a_parameter(rows):
    frame = rows(["the gas"], "text").select(
        tokens("text", ()).alias("none"), tokens("text", ("gas",)).alias("own")
    )
    assert tuple(frame.collect()[0]) == (["the", "gas"], ["the"])


def test_total_and_json(rows):
    frame = rows(["deal Deal deal gas", ""], "text").select(
        token_counts(tokens("text")).alias("c")
    )
    got = frame.select(total_tokens(F.col("c")), counts_json(F.col("c"))).collect()
    assert tuple(got[0]) == (3, '{"deal":2,"gas":1}')
    assert tuple(got[1]) == (0, "{}")
    assert json.loads(got[0][1]) == {"deal": 2, "gas": 1}


def test_long_text_is_whole(rows):
    text = "alpha " * 60_000 + "Beta " + "beta " * 60_000
    assert counts(rows, [text], True)[text] == {"alpha": 60_000, "beta": 60_001}

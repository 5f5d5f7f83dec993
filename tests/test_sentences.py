import random
import re

import pytest
from pyspark.sql import functions as F

from commwatch.functions.lexicons import TOPIC
from commwatch.functions.sentences import PLAIN, SPACE, TYPOGRAPHIC, rules, sentence_tokens
from commwatch.functions.text import wanted
from commwatch.operators.emails import score_text

CASES = [
    (
        'Mr. Smith said "don\'t go." He can\'t; it\'s 3,000, e.g. here.',
        ["Mr.", "Smith", "said", "``", "do", "n't", "go", "\'\'", "He", "ca", "n't", "it", "'s",
         "3,000", "e.g.", "here"],
    ),
    ("The U.S. Army left. J. R. Lee stayed.", ["The", "U.S.", "Army", "left", "J.", "R.", "Lee", "stayed"]),
    ("We cannot (ever) wait... You\'re gonna", ["We", "can", "not", "ever", "wait", "...", "You", "'re", "gon", "na"]),
    ("‘Twas “late”", ["'T", "was", "``", "late", "\'\'"]),
    ("mail a.b@example.com at example.com. Then stop.\n", ["mail", "a.b", "example.com", "at", "example.com", "Then", "stop"]),
    ("a/b c_d x--y alpha~beta", []),
    ("the dogs\' DON\'T", ["the", "dogs", "DO", "N'T"]),
    ("", []),
    (None, []),
]


@pytest.mark.parametrize("text, expected", CASES)
def test_tokens(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "text string").select(sentence_tokens("text", ()).alias("t"))
    assert frame.collect()[0].t == expected


def test_stop_words_and_abbreviations_are_parameters(spark):
    frame = spark.createDataFrame([("the Gen. Lee the end",)], "text string").select(
        sentence_tokens("text").alias("a"), sentence_tokens("text", (), ("Gen",)).alias("b")
    )
    row = frame.collect()[0]
    assert row.a == ["Gen", "Lee", "end"] and row.b == ["the", "Gen.", "Lee", "the", "end"]


def test_scores_by_sentence_tokens(spark):
    word = TOPIC.words[0][0]
    frame = spark.createDataFrame([(f"It is \"{word}\". They\'ve {word}\'s",)], "text string")
    row = score_text(frame, "text", (TOPIC,), tokenise=sentence_tokens).collect()[0]
    assert row.topic_hits[0] == 2


def test_nothing_leaves_the_jvm(spark):
    plan = spark.range(1).selectExpr("'x' AS text").select(sentence_tokens("text"))
    assert "Python" not in plan._jdf.queryExecution().toString()


def test_a_rule_is_tried_only_where_its_mark_is(spark):
    """The tokens are those of the whole chain, and a text without marks is not searched by it."""
    draw = random.Random(5)
    parts = ["CANNOT", "cannot", "Gonna", "d'ye", "'Tis", "'TWAS", "lemme", "don't", "DON'T", "we'll", "U.S.",
             "Mr.", "e.g.", "...", "3,000", "a:b", '"hi"', "“so”", "(x)", "end.", "\x01", "ſ", "\u0130", "İt's", "\n", "dogs'"]
    texts = [draw.choice(["", " "]).join(draw.choice(parts) + draw.choice(["", " "]) for _ in range(12)) for _ in range(300)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    plain = F.translate("text", TYPOGRAPHIC, PLAIN)
    for pattern, replacement in rules():
        plain = F.regexp_replace(plain, F.lit(pattern), F.lit(re.sub(r"\\(\d)", r"$\1", replacement)))
    wanted_words = frame.select(F.split(plain, SPACE + "+").alias("w")).withColumn("w", F.expr(f"filter(w, w -> {wanted(())})"))
    got = frame.select(sentence_tokens("text", ()).alias("w"))
    assert got.collect() == wanted_words.collect()
    plan = got._jdf.queryExecution().toString()
    assert plan.lower().count("contains(lower(") >= 19

import json

import pytest
from pyspark.sql import functions as F

from commwatch.functions.lexicons import (
    TOPIC,
    Lexicon,
    Lexicons,
    LexiconTooLarge,
    MissingLexicon,
    lexicon_table,
)
from commwatch.functions.scoring import class_hits, class_label, class_of
from commwatch.functions.text import token_counts, tokens
from commwatch.operators.emails import parse_emails, score_emails, score_text
from commwatch.operators.email_lexicon_join import score_emails_by_table
from commwatch.operators.lexicon_join import (
    class_sets,
    heavy_words,
    hits_by_join,
    is_small,
    with_classes,
)
from commwatch.plans.samples import FRAUD, POWER, SAMPLES, SENTIMENT
from commwatch.schemas import EMAIL_STREAM

SCORES = {
    # text: topic, sentiment, power, fraud
    "": (-1, -1, -1, 0.0),
    "the of": (-1, -1, -1, 0.0),
    "zzz": (0, 0, 0, 0.0),
    "trading gas": (9, 0, 0, 0.0),
    "deal": (3, 0, 0, 1.0),
    "fraud zzz": (0, 0, 0, 0.5),
    "Against": (4, 0, 0, 0.0),
    "hero manager": (6, 1, 1, 0.0),
    "gas gas game Game": (9, 0, 0, 0.0),
}


def test_email_scores(rows):
    lines = [f"{i}|p|20130101000000|f|t|{text}|{text}" for i, text in enumerate(SCORES)]
    scored = score_emails(parse_emails(rows(lines)), SAMPLES)
    assert scored.schema.names == EMAIL_STREAM.names
    assert [f.dataType for f in scored.schema] == [f.dataType for f in EMAIL_STREAM]
    got = {int(r.ip): r for r in scored.collect()}
    for i, (text, expected) in enumerate(SCORES.items()):
        r = got[i]
        content = (r.content_topic, r.content_sentiment, r.content_power, r.fraud_score)
        subject = (r.subject_topic, r.subject_sentiment, r.subject_power)
        assert content == expected, text
        assert subject == expected[:3], text
        assert json.loads(r.subject) == json.loads(r.content)


def test_null_text_counts_as_empty(rows):
    scored = score_text(rows([None], "text"), "text", (TOPIC,)).select(
        "total", class_of(F.col("total"), F.col("topic_hits"), TOPIC.class_ids)
    )
    assert tuple(scored.collect()[0]) == (0, -1)


def test_malformed_emails_are_not_scored(rows):
    assert score_emails(parse_emails(rows(["a|b|c|d|e|f", "", None])), SAMPLES).count() == 0


def test_topic_lists():
    sizes = [len(TOPIC.words[c]) for c in TOPIC.class_ids]
    assert sizes == [10] * 9 + [14, 18]
    assert all(len(set(w)) == len(w) for w in TOPIC.words.values())
    shared = {w for w in TOPIC.words[3] if w in TOPIC.words[9]}
    assert shared == {"deal"}


def test_labels(spark):
    frame = spark.createDataFrame([(9,), (-1,)], "c int").select(
        class_label(F.col("c"), TOPIC)
    )
    assert [r[0] for r in frame.collect()] == ["trading", None]


def test_words_with_quotes_and_shared_words(rows):
    own = Lexicon("own", {0: ("o'hare", "twin"), 2: ("twin",), 5: ()}, {0: "a", 2: "b", 5: "c"})
    counted = rows(["O'Hare twin twin"], "text").select(
        token_counts(tokens("text")).alias("counts")
    )
    assert counted.select(class_hits("counts", own)).collect()[0][0] == [3, 2, 0]


def test_lexicon_from_table(spark):
    with pytest.raises(MissingLexicon):
        Lexicons.from_table(lexicon_table(spark, TOPIC, SENTIMENT))
    table = lexicon_table(spark, TOPIC, SENTIMENT, POWER, FRAUD)
    loaded = Lexicons.from_table(table, topic=None)
    assert {c: set(w) for c, w in loaded.topic.words.items()} == {
        c: set(w) for c, w in TOPIC.words.items()
    }
    assert set(loaded.sentiment.words[1]) == set(SENTIMENT.words[1])
    assert loaded.power.class_ids == (0, 1)
    with pytest.raises(LexiconTooLarge):
        Lexicon.from_table(table, "topic", {}, max_words=50)
    assert is_small(table, 200) and not is_small(table, 20)


@pytest.mark.parametrize("broadcast", [True, False, None])
def test_join_equals_look_up(spark, broadcast):
    texts = [" ".join(TOPIC.words[i % 11][: i % 7]) for i in range(60)] + ["", "zzz"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    scored = score_text(frame, "text", (TOPIC,))
    lexicon = lexicon_table(spark, TOPIC).select("class_id", "word")
    joined = hits_by_join(scored, "id", lexicon, TOPIC.class_ids, broadcast=broadcast)
    expected = {r.id: (r.total, r.topic_hits) for r in scored.collect()}
    assert {r.id: (r.total, r.hits) for r in joined.collect()} == expected


def test_heavy_words_are_those_of_many_texts(spark):
    texts = [f"trading rare{i} rare{i + 1000} deal{i % 2}" for i in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    counted = frame.select("id", token_counts(tokens("text")).alias("counts"))
    assert heavy_words(counted, "id", tasks=8) == ["deal0", "deal1", "trading"]
    assert heavy_words(counted, "id", tasks=1, sample_rows=400) == ["trading"]
    assert heavy_words(counted.where("id < 0"), "id") == []


@pytest.mark.parametrize("heavy", [(), ("trading", "o'hare", "nowhere"), None])
def test_heavy_words_change_no_hits(spark, heavy):
    texts = [f"trading O'Hare gas{i} deal" * (i % 3) for i in range(50)] + [None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    own = Lexicon("own", {0: ("trading", "o'hare"), 2: ("deal", "trading"), 5: ()}, {})
    scored = score_text(frame, "text", (own,))
    lexicon = lexicon_table(spark, own).select("class_id", "word")
    joined = hits_by_join(scored, "id", lexicon, own.class_ids, broadcast=False, heavy=heavy)
    expected = {r.id: (r.total, r.own_hits) for r in scored.collect()}
    assert {r.id: (r.total, r.hits) for r in joined.collect()} == expected


def test_a_word_in_every_text_loads_no_task(spark):
    """Rows of the join by task, for a word that makes up a third of all tokens."""
    texts = [f"trading a{i}b c{i}d" for i in range(4000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    counted = frame.select("id", token_counts(tokens("text")).alias("counts"))
    rows = counted.select("id", F.explode("counts").alias("c")).select("id", "c.token", "c.n")
    words = class_sets(lexicon_table(spark, TOPIC))

    def loads(heavy):
        met = with_classes(rows, ("id",), words, heavy)
        found = met.groupBy(F.spark_partition_id().alias("task")).agg(
            F.count("*").alias("n"), F.count("classes")
        )
        return sorted(r.n for r in found.collect())

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        heavy = heavy_words(counted, "id")
        assert heavy == ["trading"]
        balanced, skewed = loads(heavy), loads(())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(balanced) == sum(skewed) == 12_000
    assert balanced[-1] <= 2 * balanced[len(balanced) // 2]
    assert skewed[-1] > 2 * skewed[len(skewed) // 2]


def emails(texts):
    return [f"{i % 5}|p|20130101000000|f|t|{text}|{text} {i % 3}" for i, text in enumerate(texts)]


def test_emails_by_table_as_by_look_up(rows):
    """Repeated lines, texts without tokens, short lines and words of several classes."""
    texts = list(SCORES) * 2 + ["gas gas Gas deal", "Deal deal deal problem hero write-off"]
    lines = emails(texts) + emails(texts)[:7] + ["a|b|c", None]
    parsed = parse_emails(rows(lines).repartition(3))
    table = lexicon_table(rows([]).sparkSession, TOPIC, SENTIMENT, POWER, FRAUD)
    expected = sorted(map(repr, score_emails(parsed, SAMPLES).collect()))
    for heavy in (None, (), ("deal", "gas")):
        scored = score_emails_by_table(parsed, table, heavy=heavy)
        assert scored.schema.names == EMAIL_STREAM.names
        assert [f.dataType for f in scored.schema] == [f.dataType for f in EMAIL_STREAM]
        assert sorted(map(repr, scored.collect())) == expected


def test_no_emails_by_table(rows):
    table = lexicon_table(rows([]).sparkSession, TOPIC, SENTIMENT, POWER, FRAUD)
    assert score_emails_by_table(parse_emails(rows([])), table).count() == 0
    with pytest.raises(MissingLexicon):
        score_emails_by_table(parse_emails(rows([])), table.where("lexicon <> 'power'"))


def test_tokens_that_grow_in_lower_case(spark):
    """Twenty dotted capitals pass the length test and are forty characters in lower case."""
    token = "\u0130" * 20
    grown = spark.sql(f"SELECT lower('{token}')").first()[0]
    own = Lexicon("own", {0: (grown,)}, {0: "long"})
    frame = spark.createDataFrame([(1, token)], "id long, text string")
    scored = score_text(frame, "text", (own,))
    assert scored.first().own_hits == [1]
    lexicon = lexicon_table(spark, own).select("class_id", "word")
    for broadcast in (True, False):
        assert hits_by_join(scored, "id", lexicon, (0,), broadcast=broadcast).first().hits == [1]


def test_empty_lexicon(rows):
    frame = score_text(rows(["gas"], "text"), "text", (Lexicon("none", {0: (), 1: ()}, {}),))
    assert frame.select("none_hits").collect()[0][0] == [0, 0]

"""Word lists by class, and the table form in which users supply their own.

The topic lists are complete. Sentiment, power and fraud lists are parameters without a default:
published lists run to thousands of words and are loaded with ``Lexicons.from_table``.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

# Words of one lexicon that may be written into a plan as literals. Larger lexicons are joined.
MAX_INLINE_WORDS = 20_000


class LexiconTooLarge(ValueError):
    """The lexicon has more words than a plan should carry; score it with a join."""


class MissingLexicon(ValueError):
    """The table has no words of a lexicon that scoring needs."""


@dataclass(frozen=True)
class Lexicon:
    """Word lists keyed by class id, in ascending id order.

    A word may be in several classes and counts once in each.
    """

    name: str
    words: dict
    labels: dict

    @property
    def class_ids(self):
        return tuple(sorted(self.words))

    def rows(self):
        return [(self.name, c, w) for c in self.class_ids for w in self.words[c]]

    @classmethod
    def from_table(cls, table, name, labels, max_words=MAX_INLINE_WORDS):
        """The lexicon called ``name`` in a table ``(lexicon, class_id, word)``.

        At most ``max_words + 1`` rows reach the driver; more words than that are refused.
        """
        rows = (
            table.where(F.col("lexicon") == name)
            .select("class_id", "word")
            .distinct()
            .limit(max_words + 1)
            .collect()
        )
        if len(rows) > max_words:
            raise LexiconTooLarge(f"lexicon {name} has more than {max_words} words")
        words = {c: [] for c in labels}
        for row in rows:
            words.setdefault(row.class_id, []).append(row.word)
        return cls(name, {c: tuple(sorted(w)) for c, w in words.items()}, dict(labels))


# Topic ids, labels and words.
TOPIC_LABELS = {
    0: "email ads",
    1: "environment",
    2: "labor law",
    3: "travel",
    4: "fantasy football",
    5: "politics",
    6: "projects",
    7: "sports",
    8: "it",
    9: "trading",
    10: "company",
}
TOPIC_WORDS = {
    0: "click free offer online price receive link web list save",
    1: "emission environmental air permit plant facility unit epa water station",
    2: "page court employees law labor worker union federal employer act",
    3: "travel hotel roundtrip fares special offer city visit miles deal",
    4: "game yard defense allowed fantasy point passing rank against team",
    5: "american bush world attack country government president war campaign member",
    6: "project request approval resource application construction manager transaction site date",
    7: "texas longhorn team game play brown season top orange football",
    8: "user data access password center server problem address sap outage",
    9: "deal trading risk position transaction book power product credit gas bid price prices market",
    10: "company stock financial dynegy investor shares billion credit rating analyst firm fund "
    "partner ventures technology round capital services",
}

SENTIMENT_LABELS = {0: "negative", 1: "positive"}
POWER_LABELS = {0: "submit", 1: "power"}
FRAUD_LABELS = {1: "fraud"}

def _lexicon(name, words, labels):
    return Lexicon(name, {c: tuple(text.split()) for c, text in words.items()}, labels)


TOPIC = _lexicon("topic", TOPIC_WORDS, TOPIC_LABELS)


@dataclass(frozen=True)
class Lexicons:
    """The four lexicons that score a message."""

    sentiment: Lexicon
    power: Lexicon
    fraud: Lexicon
    topic: Lexicon = TOPIC

    @classmethod
    def from_table(cls, table, max_words=MAX_INLINE_WORDS, topic=TOPIC):
        """All lexicons from one table; ``topic=None`` takes the topics from it too.

        A lexicon that the table lacks is an error: scores by no words at all would look like
        scores.
        """
        def load(name, labels):
            lexicon = Lexicon.from_table(table, name, labels, max_words)
            if not any(lexicon.words.values()):
                raise MissingLexicon(f"the table has no words of the lexicon {name}")
            return lexicon

        return cls(
            load("sentiment", SENTIMENT_LABELS),
            load("power", POWER_LABELS),
            load("fraud", FRAUD_LABELS),
            topic or load("topic", TOPIC_LABELS),
        )


def lexicon_table(spark, *lexicons):
    """Lexicons in table form, ``(lexicon, class_id, word)``."""
    from commwatch.schemas import LEXICON

    return spark.createDataFrame([row for lex in lexicons for row in lex.rows()], LEXICON)

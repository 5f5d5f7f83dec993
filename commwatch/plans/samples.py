"""Small word lists that stand in for a user's own lexicons in the catalogue.

They say nothing about sentiment, power or fraud: they are parameters of the queries, chosen to have
shared words, hyphens and ties. Published lists are loaded from a table, ``Lexicons.from_table``.
"""

from commwatch.functions.lexicons import (
    FRAUD_LABELS,
    POWER_LABELS,
    SENTIMENT_LABELS,
    TOPIC,
    Lexicon,
    Lexicons,
)

SENTIMENT = Lexicon(
    "sentiment",
    {0: ("problem", "sad", "broken", "late", "deal"), 1: ("hero", "happy", "bright", "deal")},
    SENTIMENT_LABELS,
)
POWER = Lexicon(
    "power", {0: ("request", "please", "wait"), 1: ("manager", "boss", "order")}, POWER_LABELS
)
FRAUD = Lexicon("fraud", {1: ("fraud", "bribe", "write-off", "deal")}, FRAUD_LABELS)
SAMPLES = Lexicons(SENTIMENT, POWER, FRAUD, TOPIC)

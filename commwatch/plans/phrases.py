"""Phrases of lexicon words, so that every class is hit by some document."""

from commwatch.functions.lexicons import TOPIC
from commwatch.plans.samples import FRAUD, POWER, SENTIMENT


def _phrase(topic):
    words = list(TOPIC.words[topic])
    words += SENTIMENT.words[topic % 2] + POWER.words[(topic // 2) % 2]
    if topic % 3 == 0:
        words += FRAUD.words[1]
    # a capital in front sets a count back under the reset rule, one behind does so differently
    return " ".join([words[0], words[1].title(), *words, words[2].title(), words[1]])


PHRASES = tuple(_phrase(topic) for topic in TOPIC.class_ids) + ("",)

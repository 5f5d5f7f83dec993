r"""Tokens by sentences, contractions and quotes: an alternative to ``text.tokens``.

A text passes through a fixed chain of replacements that put spaces around what is a token of its own, and
is then split at white space. Nothing leaves the JVM. The chain follows the well-known conventions
for English corpora:

* a full stop is a token where a sentence ends: before white space and a capital, digit, quote or bracket,
  or at the end of the text; it stays with an abbreviation, an initial, or inside a word;
* ``don't`` is ``do n't``, ``it's`` is ``it 's``, ``cannot`` is ``can not``;
* opening double quotes are ` `` `, closing ones are ``''``; typographic quotes count as plain ones;
* commas and colons stay inside numbers; other punctuation stands alone, three dots are one token.
"""

import re

from pyspark.sql import functions as F

from commwatch.functions.binding import text_list
from commwatch.functions.stopwords import ENGLISH
from commwatch.functions.text import wanted

# Abbreviations that keep their full stop: fixed values.
ABBREVIATIONS = (
    "Mr", "Mrs", "Ms", "Dr", "Prof", "St", "Jr", "Sr", "Inc", "Co", "Corp", "Ltd", "No", "vs",
    "e.g", "i.e", "etc", "cf", "a.m", "p.m", "Jan", "Feb", "Mar", "Apr", "Jun", "Jul", "Aug",
    "Sep", "Sept", "Oct", "Nov", "Dec",
)
# Words that are written as one and count as two: fixed values.
JOINED = (
    ("can", "not"), ("d'", "ye"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"),
    ("wan", "na"), ("'t", "is"), ("'t", "was"),
)
SPACE = r"[ \t\r\n]"
END = r"([^\p{L}\p{N}]|\z)"
KEPT_STOP = "\x01"  # stands for a full stop that ends no sentence
TYPOGRAPHIC, PLAIN = "‘’“”", "''\"\""


def rules(abbreviations=ABBREVIATIONS):
    """Patterns and replacements in order; ``\\1`` is the first group.

    They use no look-around, so that engines without it can run the same chain.
    """
    kept = "|".join(re.escape(a) for a in sorted(abbreviations, key=lambda a: (-len(a), a)))
    initials = r"(?:\p{Lu}\.)*\p{Lu}"
    chain = [
        (KEPT_STOP, " "),
        (rf'(^|{SPACE}|[(\[{{<])"', r"\1 `` "),
        ('"', " '' "),
        (r"\.\.\.", " ... "),
        (r"([;@#$%&?!()\[\]{}<>])", r" \1 "),
        (r"([:,])([^0-9]|\z)", r" \1 \2"),
        (rf"(^|[^\p{{L}}.])({initials}{'|' + kept if kept else ''})\.", rf"\1\2{KEPT_STOP}"),
        # what is left at the end of a word, before something that may begin a sentence
        (rf"([^. \t\r\n])\.((?:{SPACE}*['\])}}>])*)({SPACE}+[\p{{Lu}}\p{{N}}`'(\[]|{SPACE}*\z)", r"\1 . \2\3"),
        (KEPT_STOP, "."),
        (r"(\p{L})(n't|N'T)" + END, r"\1 \2\3"),
        (r"([\p{L}\p{N}])('(?:s|S|m|M|d|D|ll|LL|re|RE|ve|VE))" + END, r"\1 \2\3"),
        (rf"([^' \t\r\n])'({SPACE}|\z)", r"\1 ' \2"),
    ]
    for first, second in JOINED:
        chain.append((rf"(?i)(^|[^\p{{L}}'])({first})({second})" + END, r"\1\2 \3\4"))
    return chain


def _marks():
    """For each of the ``rules`` what every text that it changes has in lower case, or None.

    Looking for that costs a fraction of trying the pattern at every place of the text.
    """
    chain = [KEPT_STOP, '"', '"', "...", None, None, ".", ".", KEPT_STOP, "n't", "'", "'"]
    return [*chain, *((first + second).lower() for first, second in JOINED)]


def sentence_tokens(text, stop_words=ENGLISH, abbreviations=ABBREVIATIONS):
    """Tokens, in order and as written, of the text in a column, given by its name.

    They are filtered as those of ``text.tokens``: by length, stop words (compared as written) and
    marks that drop a token. Null text has no tokens.
    """
    spaced = f"translate(coalesce(`{text}`, ''), {text_list([TYPOGRAPHIC])}, {text_list([PLAIN])})"
    for (pattern, replacement), mark in zip(rules(abbreviations), _marks(), strict=True):
        replacement = re.sub(r"\\(\d)", r"$\1", replacement)
        replaced = f"regexp_replace(t, {text_list([pattern])}, {text_list([replacement])})"
        if mark:
            replaced = f"IF(contains(lower(t), {text_list([mark])}), {replaced}, t)"
        # the text of the rule before is computed once, as the argument of a function
        spaced = f"transform(array({spaced}), t -> {replaced})[0]"
    words = f"split({spaced}, {text_list([SPACE + '+'])})"
    return F.expr(f"filter({words}, w -> {wanted(stop_words)})")

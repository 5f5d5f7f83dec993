"""Text to tokens to token counts, within a row: no explode, no shuffle."""

from pyspark.sql import functions as F

from commwatch.functions.binding import bind, text_list
from commwatch.functions.stopwords import ENGLISH

# / \ ~ # _ belong to a token so that the shape test can drop the whole token
TOKEN_PATTERN = r"[\p{L}\p{N}/\\~#_]+(?:[-'.][\p{L}\p{N}/\\~#_]+)*"
UNWANTED = ("/", "\\", "--", "~", "#", "_")
MAX_LENGTH = 30
# The tokens of TOKEN_PATTERN, of which the first group has those without an unwanted mark and is empty
# for the others. Nothing is given back once matched, so that any text takes linear time and no stack.
CLEAN_PATTERN = (
    r"([\p{L}\p{N}]++(?:[-'.][\p{L}\p{N}]++)*+)(?![-'.]?[/\\~#_])"
    r"|[\p{L}\p{N}/\\~#_]++(?:[-'.][\p{L}\p{N}/\\~#_]++)*+"
)


def wanted(stop_words, marks=UNWANTED):
    """SQL condition on a token ``w``: no stop word as written, its length, no unwanted mark."""
    tests = [f"w NOT IN ({text_list(stop_words)})"] if stop_words else []
    tests.append(f"length(w) BETWEEN 2 AND {MAX_LENGTH}")
    # plain searches, which cost less than a pattern on every word
    tests += [f"NOT contains(w, {text_list([mark])})" for mark in marks]
    return " AND ".join(tests)


def tokens(text, stop_words=ENGLISH):
    """Tokens, in order and as written, of the text in a column, given by its name.

    Stop words are compared before lower-casing: ``the`` goes and ``The`` stays. Null text has
    no tokens. The pattern itself sets tokens with an unwanted mark apart, as empty ones, which
    costs less than six searches on every token.
    """
    found = f"regexp_extract_all(coalesce(`{text}`, ''), {text_list([CLEAN_PATTERN])}, 1)"
    return F.expr(f"filter({found}, w -> {wanted(stop_words, marks=())})")


def token_counts(words, reset=True):
    """Counts of the lower-cased tokens as a token-sorted array of ``(token, n)``.

    With ``reset`` a token written with a capital sets its count back to one, so ``n`` counts the
    occurrences from the last capitalised one on (all of them where there is none). Without it
    ``n`` counts every occurrence.

    The tokens of a text are sorted by token and place, which makes equal tokens neighbours. One pass
    finds the places where a run begins or a capitalised token sets it back. The last of these in
    each run is where its count starts, and the next run's first is where it ends: O(n log n) in the
    length of the text and local to the row. The passes after the sort handle indexes only, as
    building a struct per token would cost more than the rest.
    """
    placed = F.transform(
        words,
        lambda word, place: F.struct(
            F.lower(word).alias("token"), place.alias("place"), word.alias("written")
        ),
    )

    def runs(ordered, token):
        def starts(item, i):
            # null beyond either end of the array differs from every token
            begins = ~F.get(token, i - 1).eqNullSafe(item["token"])
            return F.when((item["written"] != item["token"]) | begins if reset else begins, i)

        def counted(places):
            def count(start, k):
                following = F.get(places, k + 1)
                last = ~F.get(token, start).eqNullSafe(F.get(token, following))
                n = F.coalesce(following, F.size(token)) - start
                return F.when(
                    last, F.struct(F.get(token, start).alias("token"), n.cast("bigint").alias("n"))
                )

            return F.array_compact(F.transform(places, count))

        return bind(F.array_compact(F.transform(ordered, starts)), counted)

    return bind(
        F.sort_array(placed),
        lambda ordered: bind(ordered["token"], lambda token: runs(ordered, token)),
    )


def total_tokens(counts):
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda total, c: total + c["n"])


def counts_json(counts):
    """Token counts as a JSON object, keys in token order."""
    return F.to_json(F.map_from_entries(counts))

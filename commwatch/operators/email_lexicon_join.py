"""Scoring parsed emails by lexicons of any size, kept as a table and joined.

The lexicons stay a table ``(lexicon, class_id, word)`` from end to end: no word is written into a plan
or reaches the driver but the few heavy ones that ``lexicon_join`` deals out apart.
"""

from pyspark.sql import functions as F

from commwatch.functions import scoring
from commwatch.functions.lexicons import (
    FRAUD_LABELS,
    POWER_LABELS,
    SENTIMENT_LABELS,
    TOPIC_LABELS,
    MissingLexicon,
)
from commwatch.functions.stopwords import ENGLISH
from commwatch.functions.text import counts_json, token_counts, tokens, total_tokens
from commwatch.operators.lexicon_join import class_sets, heavy_words, with_classes
from commwatch.operators.validity import valid
from commwatch.schemas import EMAIL_STREAM

LABELS = {
    "sentiment": SENTIMENT_LABELS,
    "power": POWER_LABELS,
    "topic": TOPIC_LABELS,
    "fraud": FRAUD_LABELS,
}
# each class of each lexicon has a place in the array of hits
SLOTS = [(name, class_id) for name in LABELS for class_id in sorted(LABELS[name])]
FIELDS = ("subject", "content")
KEY = ("key_1", "key_2")


def email_class_sets(lexicons):
    """One row per word of a lexicon table: the word and the places of the classes it is in.

    Words of other lexicons or classes are left out. A table that lacks all words of a lexicon is an
    error: scores by no words at all would look like scores.
    """
    place = F.coalesce(
        *[
            F.when((F.col("lexicon") == name) & (F.col("class_id") == class_id), F.lit(i))
            for i, (name, class_id) in enumerate(SLOTS)
        ]
    )
    listed = lexicons.select(place.alias("class_id"), "word").where("word IS NOT NULL")
    listed = listed.where(F.col("class_id").isNotNull())
    there = {SLOTS[r.class_id][0] for r in listed.select("class_id").distinct().collect()}
    missing = [name for name in LABELS if name not in there]
    if missing:
        raise MissingLexicon(f"the table has no words of the lexicons {', '.join(missing)}")
    return class_sets(listed)


def _counted(parsed, stop_words, reset):
    return parsed.withColumns(
        {f"{f}_counts": token_counts(tokens(f, stop_words), reset) for f in FIELDS}
    )


def email_heavy_words(parsed, stop_words=ENGLISH, reset=True, **options):
    """The ``heavy_words`` of both fields of parsed emails."""
    keyed = parsed.select(F.xxhash64(*parsed.columns).alias("key"), *FIELDS)
    both = F.concat(*[f"{f}_counts" for f in FIELDS])
    counted = _counted(keyed, stop_words, reset).select("key", both.alias("counts"))
    return heavy_words(counted, "key", **options)


def email_table_scorer(words, stop_words=ENGLISH, reset=True, heavy=()):
    """A transform like that of ``email_scorer``, by the words of ``email_class_sets``.

    An email becomes one row per distinct token of either field, and one that carries its columns.
    The tokens are joined with ``words`` once for all lexicons, and the rows of an email meet again
    by a hash of 128 bits of its columns, in one aggregation that sums the hits by field. So a text
    is read and counted once, and no number has to be given to it. Equal emails share their hash;
    each then has its share of the sums.
    """
    def score(parsed):
        kept = [c for c in parsed.columns if c not in FIELDS]
        # nulls do not enter a hash: without a stand-in they could change places with a value
        known = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in parsed.columns]
        counted = _counted(parsed, stop_words, reset)
        carried = F.struct(
            *kept,
            *(counts_json(F.col(f"{f}_counts")).alias(f) for f in FIELDS),
            *(total_tokens(F.col(f"{f}_counts")).alias(f"{f}_total") for f in FIELDS),
        ).alias("email")
        described = counted.select(
            F.xxhash64(*known).alias(KEY[0]),
            F.xxhash64(F.lit(1), *known).alias(KEY[1]),
            *(f"{f}_counts" for f in FIELDS),
            carried,
        )
        shape = described.schema["email"].dataType

        def row(field, token, n, email):
            return F.struct(
                F.lit(field).cast("int").alias("field"),
                token.cast("string").alias("token"),
                n.cast("bigint").alias("n"),
                email.cast(shape).alias("email"),
            )

        def token_row(field):
            return lambda c: row(field, c["token"], c["n"], null)

        null = F.lit(None)
        each = [F.array(row(None, null, null, F.col("email")))]
        each += [F.transform(f"{f}_counts", token_row(i)) for i, f in enumerate(FIELDS)]
        rows = described.select(*KEY, F.explode(F.concat(*each)).alias("r")).select(*KEY, "r.*")
        found = with_classes(rows, KEY, words, heavy)

        def hits(i, place):
            here = (F.col("field") == i) & F.array_contains("classes", F.lit(place))
            return F.coalesce(F.sum(F.when(here, F.col("n"))), F.lit(0).cast("bigint"))

        met = found.groupBy(*KEY).agg(
            F.first("email", ignorenulls=True).alias("email"),
            F.count("email").alias("copies"),
            *(
                F.array(*[hits(i, place) for place in range(len(SLOTS))]).alias(f"{f}_hits")
                for i, f in enumerate(FIELDS)
            ),
        )
        own = {f"{f}_hits": F.expr(f"transform({f}_hits, h -> h div copies)") for f in FIELDS}
        copies = F.explode(F.array_repeat("email", F.col("copies").cast("int"))).alias("email")
        emails = met.withColumns(own).select(*(f"{f}_hits" for f in FIELDS), copies)
        return emails.select("email.*", *(f"{f}_hits" for f in FIELDS)).select(
            *kept, *FIELDS, *_scores()
        )

    return score


def _scores():
    """Classes and fraud score of an email with totals and hits of both fields."""
    def hits(field, name):
        places = [i for i, (n, _) in enumerate(SLOTS) if n == name]
        return F.slice(f"{field}_hits", places[0] + 1, len(places))

    fraud = F.get(hits("content", "fraud"), F.lit(0))
    yield scoring.share(fraud, F.col("content_total")).alias("fraud_score")
    for name in ("sentiment", "power", "topic"):
        for f in FIELDS:
            best = scoring.class_of(F.col(f"{f}_total"), hits(f, name), tuple(sorted(LABELS[name])))
            yield best.alias(f"{f}_{name}")


def score_emails_by_table(parsed, lexicons, heavy=None, **options):
    """Rows of ``email_stream`` for the valid records, by a lexicon table of any size.

    The table is read several times: store one that is costly to derive. ``heavy`` are the words to
    deal out apart, ``email_heavy_words`` where none are given.
    """
    usable = valid(parsed)
    if heavy is None:
        heavy = email_heavy_words(usable, **options)
    score = email_table_scorer(email_class_sets(lexicons), heavy=heavy, **options)
    return score(usable).select(*EMAIL_STREAM.fieldNames())

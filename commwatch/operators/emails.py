"""Email records: encode, parse, score."""

from pyspark.sql import functions as F

from commwatch.functions import scoring
from commwatch.functions.parsing import fields
from commwatch.functions.stopwords import ENGLISH
from commwatch.functions.text import counts_json, token_counts, tokens, total_tokens
from commwatch.functions.wire import addresses, envelope, multi_value, sanitise
from commwatch.operators.validity import TOO_FEW_FIELDS, valid
from commwatch.schemas import EMAIL_STREAM

FIELDS = ("ip", "port", "date_time", "fr", "to", "subject", "content")


def encode_emails(corpus, ip, port, event_time="event_time"):
    """Lines ``ip|port|time|from~from|to~to|subject|content`` from an email corpus."""
    line = envelope(
        F.lit(ip),
        F.lit(port),
        F.col(event_time),
        multi_value(addresses(F.col("mailfrom"))),
        multi_value(addresses(F.col("torecipients"))),
        sanitise(F.col("subject")),
        sanitise(F.col("content")),
    )
    return corpus.select(line.alias("value"))


def parse_emails(lines):
    """The seven named fields of each line, their number and the ``reason`` to reject it, if any.

    ``to`` stays one string and fields past the seventh are ignored.
    """
    return lines.withColumn("parts", fields(F.col("value"))).select(
        "value",
        *[F.get("parts", F.lit(i)).alias(name) for i, name in enumerate(FIELDS)],
        F.size("parts").alias("n_fields"),
        F.when(F.size("parts") < len(FIELDS), F.lit(TOO_FEW_FIELDS)).alias("reason"),
    )


def text_scorer(text, lexicons, stop_words=ENGLISH, reset=True, prefix="", tokenise=tokens):
    """A transform that scores a text column.

    It adds ``<prefix>counts``, ``<prefix>total`` and ``<prefix><lexicon>_hits``: the token counts,
    their total, and the hits per class of each lexicon. All of it is computed within the row, so
    no row key is needed and nothing is shuffled. One pass over the counts finds the tokens of any
    lexicon, and the classes are tried on those alone. The steps are separate projections, which
    keeps Catalyst from repeating one inside the next. The expressions are built here,
    once, however often the transform is applied.
    """
    counts = f"{prefix}counts"
    counting = token_counts(tokenise(text, stop_words), reset)
    known = f"{prefix}known"
    finding = {
        f"{prefix}total": total_tokens(F.col(counts)),
        known: scoring.known_tokens(counts, lexicons),
    }
    scores = {
        f"{prefix}{lexicon.name}_hits": scoring.class_hits(known, lexicon) for lexicon in lexicons
    }
    return lambda df: (
        df.withColumn(counts, counting).withColumns(finding).withColumns(scores).drop(known)
    )


def score_text(df, text, lexicons, **options):
    return text_scorer(text, lexicons, **options)(df)


def email_scorer(lexicons, stop_words=ENGLISH, reset=True, tokenise=tokens):
    """A transform that gives parsed emails their classes and fraud score.

    ``subject`` and ``content`` become the JSON of their token counts. A field without tokens has
    classes -1 and fraud score 0.0. The fraud score covers the content only. ``tokenise`` is
    ``text.tokens`` or ``sentences.sentence_tokens``.
    """
    three = (lexicons.sentiment, lexicons.power, lexicons.topic)
    subject = text_scorer("subject", three, stop_words, reset, "subject_", tokenise)
    content = text_scorer("content", (*three, lexicons.fraud), stop_words, reset, "content_", tokenise)
    columns = [
        counts_json(F.col("subject_counts")).alias("subject"),
        counts_json(F.col("content_counts")).alias("content"),
        scoring.share(F.get("content_fraud_hits", F.lit(0)), F.col("content_total")).alias(
            "fraud_score"
        ),
    ]
    for lexicon in three:
        for field in ("subject", "content"):
            hits = F.col(f"{field}_{lexicon.name}_hits")
            best = scoring.class_of(F.col(f"{field}_total"), hits, lexicon.class_ids)
            columns.append(best.alias(f"{field}_{lexicon.name}"))

    def score(parsed):
        others = [c for c in parsed.columns if c not in ("subject", "content")]
        return content(subject(parsed)).select(*others, *columns)

    return score


def score_emails(parsed, lexicons, **options):
    """Rows of ``email_stream`` for the valid records."""
    scored = email_scorer(lexicons, **options)(valid(parsed))
    return scored.select(*EMAIL_STREAM.fieldNames())

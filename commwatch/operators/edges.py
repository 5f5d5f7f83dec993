"""Sender-to-recipient edges."""

from pyspark.sql import functions as F

from commwatch.functions.flags import is_recipient
from commwatch.functions.wire import VALUE_SEPARATOR
from commwatch.operators.emails import parse_emails
from commwatch.operators.validity import TOO_FEW_FIELDS, rejected

MIN_FIELDS = 6


def edges_of(parsed):
    """One ``(fr, to, dt)`` row per valid recipient of each parsed email.

    Recipients are ``~``-separated; repeated ones and the sender itself are kept. The sender field
    is one string. Lines with fewer than six fields give no edge, while those with six do although
    they are too short to score.
    """
    # the guard is part of the exploded expression: as a filter it would split the line twice
    recipients = F.when(
        F.col("n_fields") >= MIN_FIELDS,
        F.filter(F.split("to", VALUE_SEPARATOR), is_recipient),
    )
    return parsed.select("fr", F.explode(recipients).alias("to"), F.col("date_time").alias("dt"))


def rejected_edges(parsed):
    """Lines with too few fields to give an edge."""
    short = F.when(F.col("n_fields") < MIN_FIELDS, F.lit(TOO_FEW_FIELDS))
    return rejected(parsed.withColumn("reason", short))


def edges(lines):
    return edges_of(parse_emails(lines))

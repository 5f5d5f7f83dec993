"""Counts of messages and of records."""

from pyspark.sql import functions as F

from commwatch.functions.parsing import fields, parse_time
from commwatch.operators.validity import BAD_TIME, TOO_FEW_FIELDS, valid

BATCH = "1 second"


def parse_messages(lines):
    """``event_time`` and ``message`` (the fourth field) of each line, and why it cannot be counted.

    ``event_time`` is the time on the clock as written, without a zone, so that windows do not
    depend on the session's zone nor meet missing or repeated hours.
    """
    named = lines.select("value", fields(F.col("value")).alias("parts")).select(
        "value",
        parse_time(F.get("parts", F.lit(2))).alias("event_time"),
        F.get("parts", F.lit(3)).alias("message"),
    )
    reason = F.when(F.col("message").isNull(), F.lit(TOO_FEW_FIELDS)).when(
        F.col("event_time").isNull(), F.lit(BAD_TIME)
    )
    return named.withColumn("reason", reason)


def timed_messages(lines):
    """``event_time`` and ``message`` of the lines that can be counted; the others are ``rejected``."""
    return valid(parse_messages(lines))


def message_counts(messages, window=BATCH):
    """Messages by window and text. On a stream, set a watermark on ``event_time`` first."""
    return (
        messages.groupBy(F.window("event_time", window), "message")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), "message", "n")
    )


def fourth_char_counts(lines):
    """Count of the fourth character over all fields of all lines; shorter fields do not count."""
    return (
        lines.select(F.explode(fields(F.col("value"))).alias("field"))
        .where(F.length("field") >= 4)
        .groupBy(F.substring("field", 4, 1).alias("character"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def batch_counts(records, event_time="event_time", window=BATCH):
    """Records per window."""
    return (
        records.groupBy(F.window(event_time, window))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), "n")
    )

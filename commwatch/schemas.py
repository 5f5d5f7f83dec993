"""Column layouts of the inputs and the sink tables."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _columns(kind, *names):
    return [StructField(name, kind, True) for name in names]


LINES = StructType(_columns(StringType(), "value"))

EMAIL_CORPUS = StructType(
    _columns(StringType(), "mailfrom", "torecipients", "subject", "content")
)

PEOPLE = StructType(_columns(StringType(), "address"))

LEXICON = StructType(
    _columns(StringType(), "lexicon")
    + _columns(IntegerType(), "class_id")
    + _columns(StringType(), "word")
)

TRANS_STREAM = StructType(
    _columns(StringType(), "ip", "port", "date_time", "user")
    + _columns(DoubleType(), "amount")
    + _columns(IntegerType(), "big_trans", "is_in_odd_day", "is_at_odd_time")
)

EMAIL_STREAM = StructType(
    _columns(StringType(), "ip", "port", "date_time", "fr", "to", "subject", "content")
    + _columns(
        IntegerType(),
        "subject_sentiment",
        "content_sentiment",
        "subject_power",
        "content_power",
        "subject_topic",
        "content_topic",
    )
    + _columns(DoubleType(), "fraud_score")
)

EMAIL_GRAPH = StructType(_columns(StringType(), "fr", "to", "dt"))

TWEET_STREAM = StructType(_columns(StringType(), "ip", "port", "date_time", "user", "msg"))

MESSAGE_COUNTS = StructType(
    _columns(TimestampNTZType(), "window_start")
    + _columns(StringType(), "message")
    + _columns(LongType(), "n")
)

REJECTED = StructType(_columns(StringType(), "value", "reason"))

SINK_TABLES = {
    "trans_stream": TRANS_STREAM,
    "email_stream": EMAIL_STREAM,
    "email_graph": EMAIL_GRAPH,
    "tweet_stream": TWEET_STREAM,
    "rejected": REJECTED,
}

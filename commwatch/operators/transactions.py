"""Transaction records: encode, parse, flag."""

from pyspark.sql import functions as F

from commwatch.functions import flags
from commwatch.functions.parsing import fields, parse_amount, parse_time
from commwatch.functions.wire import amount_text, envelope
from commwatch.operators.validity import BAD_AMOUNT, TOO_FEW_FIELDS, valid
from commwatch.schemas import TRANS_STREAM

FIELDS = ("ip", "port", "date_time", "user")


def encode_transactions(df, ip, port, event_time="event_time", user="user", amount="amount"):
    """Lines ``ip|port|time|user|amount`` in a column ``value``."""
    line = envelope(
        F.lit(ip), F.lit(port), F.col(event_time), F.col(user), amount_text(F.col(amount))
    )
    return df.select(line.alias("value"))


def parse_transactions(lines):
    """Named fields of each line, with ``event_time`` and the ``reason`` to reject it, if any.

    A line needs five fields and a number as amount. A bad time leaves ``event_time`` null.
    """
    named = lines.withColumn("parts", fields(F.col("value"))).select(
        "value",
        *[F.get("parts", F.lit(i)).alias(name) for i, name in enumerate(FIELDS)],
        parse_amount(F.get("parts", F.lit(4))).alias("amount"),
        F.size("parts").alias("n_fields"),
    )
    reason = F.when(F.col("n_fields") < 5, F.lit(TOO_FEW_FIELDS)).when(
        F.col("amount").isNull(), F.lit(BAD_AMOUNT)
    )
    return named.select(
        "value",
        *FIELDS,
        "amount",
        parse_time(F.col("date_time")).alias("event_time"),
        reason.alias("reason"),
    )


def flag_transactions(
    parsed,
    threshold=flags.BIG_AMOUNT,
    odd_days=(flags.SUNDAY,),
    first_hour=flags.FIRST_HOUR,
    last_hour=flags.LAST_HOUR,
):
    """Rows of ``trans_stream`` for the valid records."""
    when = F.col("event_time")
    return (
        valid(parsed)
        .withColumns(
            {
                "big_trans": flags.big_amount(F.col("amount"), threshold),
                "is_in_odd_day": flags.on_odd_day(when, odd_days),
                "is_at_odd_time": flags.at_odd_hour(when, first_hour, last_hour),
            }
        )
        .select(*TRANS_STREAM.fieldNames())
    )

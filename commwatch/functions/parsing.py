"""Reading delimited records: fields, amounts, times."""

from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INFINITY = r"^\s*[+-]?(?i:inf|infinity)\s*$"
_NAN = r"^\s*[+-]?(?i:nan)\s*$"
_TIME = r"^\d{14}$"


def fields(value):
    """Fields of a ``|``-delimited line; trailing empty fields are kept."""
    return F.split(F.coalesce(value, F.lit("")), r"\|", -1)


def parse_amount(text):
    """Amount as double, null for text that is no number.

    The pattern comes first because a cast alone would also accept type suffixes such as ``1d``.
    """
    return F.when(text.rlike(_NUMBER) | text.rlike(_INFINITY), text.try_cast("double")).when(
        text.rlike(_NAN), F.lit(float("nan"))
    )


def parse_time(text):
    """Wall-clock time of a 14-digit ``yyyyMMddHHmmss`` text, null when it is no valid time.

    The result has no time zone, so weekday and hour do not depend on the session's zone.
    """
    def part(start, length):
        return F.substring(text, start, length).try_cast("int")

    year, second = part(1, 4), part(13, 2)
    made = F.try_make_timestamp_ntz(
        year, part(5, 2), part(7, 2), part(9, 2), part(11, 2), second
    )
    return F.when(text.rlike(_TIME) & (year >= 1) & (second < 60), made)


def utc_instant(wall_clock):
    """The instant at which a clock in UTC shows a time without a zone, whatever the session's zone."""
    parts = [f(wall_clock) for f in (F.year, F.month, F.day, F.hour, F.minute)]
    second = F.extract(F.lit("SECOND"), wall_clock)
    return F.make_timestamp_ltz(*parts, second, F.lit("UTC"))


def utc_wall_clock(instant):
    """The inverse of ``utc_instant``."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)

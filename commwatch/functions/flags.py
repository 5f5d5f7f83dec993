"""0/1 flags of a transaction. An unknown time or amount gives 0."""

from pyspark.sql import functions as F

BIG_AMOUNT = 10000.0
SUNDAY = 6  # Monday is 0
FIRST_HOUR = 7
LAST_HOUR = 22


def _flag(condition):
    return F.coalesce(condition, F.lit(False)).cast("int")


def big_amount(amount, threshold=BIG_AMOUNT):
    # NaN orders above every number in Spark, hence the guard
    return _flag((F.abs(amount) >= threshold) & ~F.isnan(amount))


def on_odd_day(event_time, days=(SUNDAY,)):
    return _flag(F.weekday(event_time).isin(*days))


def at_odd_hour(event_time, first=FIRST_HOUR, last=LAST_HOUR):
    hour = F.hour(event_time)
    return _flag((hour < first) | (hour > last))


def is_recipient(address):
    """An address that may receive an edge: has ``@`` and more than five characters."""
    return address.contains("@") & (F.length(address) > 5)

"""Record filters."""

from pyspark.sql import functions as F

from commwatch.functions.flags import SUNDAY

LAST_YEAR = 2015


def business_days(df, event_time, days_off=(SUNDAY,)):
    return df.where(~F.weekday(event_time).isin(*days_off))


def until_year(df, event_time, last_year=LAST_YEAR):
    # a range on the bare column, unlike year(), reaches the Parquet scan
    end = F.lit(f"{last_year + 1:04d}-01-01").cast("timestamp_ntz")
    return df.where(F.col(event_time) < end)


def people(df, address="address"):
    """Entries that look like an address."""
    return df.where(F.col(address).contains("@"))

"""Splitting parsed records into usable and rejected ones."""

from pyspark.sql import functions as F

TOO_FEW_FIELDS = "too few fields"
BAD_AMOUNT = "bad amount"
BAD_TIME = "bad time"


def keep(parsed, condition):
    """Records that meet a condition on parsed columns.

    A filter would be pushed below the projection that parses the line and parse it a second time.
    Exploding an array of one record, or null, parses once.
    """
    record = F.when(condition, F.array(F.struct("*")))
    return parsed.select(F.explode(record).alias("record")).select("record.*")


def valid(parsed):
    """The usable records, without the raw line."""
    return keep(parsed.drop("value"), F.col("reason").isNull()).drop("reason")


def rejected(parsed):
    """Rejected lines as they came, each with its reason."""
    return keep(parsed.select("value", "reason"), F.col("reason").isNotNull())

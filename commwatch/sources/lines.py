"""Delimited lines as a one-column DataFrame ``value``."""

from pyspark.sql import functions as F

from commwatch.schemas import LINES

# Per source, what may bound a batch, and the bound where none is given.
LIMITS = {
    "text": ({"files": "maxFilesPerTrigger", "size": "maxBytesPerTrigger"}, {"files": 1000}),
    "kafka": ({"rows": "maxOffsetsPerTrigger"}, {"rows": 1_000_000}),
    "socket": ({}, {}),
}
STREAM_FORMATS = tuple(LIMITS)


def admission(source, **limits):
    """Spark's options that bound what a batch takes in: ``files`` or ``size`` in bytes, or ``rows``.

    Without any, a start after a long pause would take the whole backlog in one batch. Files are
    bounded by their number or their size, rows of Kafka by their number; a socket cannot be bounded.
    """
    known, usual = LIMITS[source]
    given = {k: v for k, v in limits.items() if v is not None}
    unknown = sorted(set(given) - set(known))
    if unknown:
        raise ValueError(f"{source} cannot bound a batch by {', '.join(unknown)}")
    if len(given) > 1:
        raise ValueError("a batch is bounded by one of its limits")
    return {known[k]: str(v) for k, v in (given or usual).items()}


def read_lines(spark, path):
    return spark.read.schema(LINES).text(path)


def stream_lines(spark, source="text", files=None, size=None, rows=None, **options):
    """Unbounded lines from a folder of text files, a socket or a Kafka topic.

    ``options`` are those of the Spark source: ``path`` for text, ``host`` and ``port`` for a
    socket, ``kafka.bootstrap.servers`` and ``subscribe`` for Kafka. ``files``, ``size`` and ``rows``
    bound a batch as in ``admission``, unless the options do so themselves. The socket source cannot
    replay, so a restart may lose lines there.
    """
    if source not in STREAM_FORMATS:
        raise ValueError(f"source must be one of {STREAM_FORMATS}")
    limits = admission(source, files=files, size=size, rows=rows)
    if not set(options) & set(LIMITS[source][0].values()):
        options = limits | options
    reader = spark.readStream.format(source)
    if source == "text":
        reader = reader.schema(LINES)
    return reader.options(**options).load().select(F.col("value").cast("string").alias("value"))

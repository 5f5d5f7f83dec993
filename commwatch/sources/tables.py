"""People, email corpora, lexicons, and tables read as streams."""

from commwatch.operators.filters import people
from commwatch.schemas import EMAIL_CORPUS, LEXICON, PEOPLE
from commwatch.sources.lines import admission


def read_people(spark, path, fmt="text"):
    """The entries of a people list that look like addresses, in a column ``address``.

    Text files hold one entry a line; other formats have a column ``address``.
    """
    if fmt == "text":
        entries = spark.read.text(path).withColumnRenamed("value", "address")
    else:
        entries = spark.read.schema(PEOPLE).format(fmt).load(path)
    return people(entries)


def read_emails(spark, path, fmt="parquet"):
    return spark.read.schema(EMAIL_CORPUS).format(fmt).load(path)


def read_lexicon(spark, path, fmt="csv", **options):
    """A lexicon table ``(lexicon, class_id, word)``; CSV files have a header line."""
    if fmt == "csv":
        options = {"header": "true", **options}
    return spark.read.schema(LEXICON).format(fmt).options(**options).load(path)


def stream_table(spark, path, schema, files=None, size=None, **options):
    """A Parquet table as a stream, whether ``path`` is one file or a folder of files.

    The streaming source refuses a bare file name but takes a pattern that matches just it.
    ``files`` or ``size`` bound a batch as in ``admission``.
    """
    pattern = f"{path[:-1]}[{path[-1]}]"
    options = admission("text", files=files, size=size) | options
    return spark.readStream.schema(schema).options(**options).parquet(pattern)

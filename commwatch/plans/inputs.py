"""Records that Spark derives from the benchmark tables: lines, headers, texts to score."""

from pyspark.sql import functions as F

from commwatch.functions.text import tokens
from commwatch.functions.wire import delimited
from commwatch.operators.emails import encode_emails
from commwatch.operators.transactions import encode_transactions
from commwatch.plans.phrases import PHRASES
from commwatch.sources.tables import stream_table

IP = "127.0.0.1"
TRANS_PORT = "1235"
EMAIL_PORT = "1237"
START = "2013-01-01 00:00:00"
ORDER_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate"
)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PARTS = 3
SPOKEN = (
    (" the ", " don't "), (" and ", ' "they\'re" '), (" of ", " cannot, Mr. "), (" in ", " U.S. Army: 3,000 "),
    (" to ", " (e.g. it's) … "), (" is ", " dogs' “gonna” go... "),
)


def by_number(rows, key):
    """Rows in as many parts as there are batches, by a whole number."""
    return [rows.where(F.pmod(key, F.lit(PARTS)) == i) for i in range(PARTS)]


def by_time(rows, time):
    """Rows in as many spans of time of equal length, in order."""
    first, last = rows.agg(F.min(time), F.max(time)).first()
    if first is None:
        return [rows] * PARTS
    ends = [first + (last - first) * (i + 1) / PARTS for i in range(PARTS - 1)]
    part = sum((F.col(time) >= F.lit(str(end)).cast("timestamp_ntz")).cast("int") for end in ends)
    return [rows.where(part == i) for i in range(PARTS)]


def fed(spark, folder, parts, start):
    """A stream that is started anew for each part of its input; each is a batch of its own.

    ``start`` gets the stream of the table in the folder and returns the running query.
    """
    for part in parts:
        part.write.mode("append").parquet(f"{folder}/input")
        start(stream_table(spark, f"{folder}/input", part.schema)).awaitTermination()


def transactions(events):
    """Amounts large enough for the big-amount flag, negative for one event type."""
    sign = F.when(F.col("event_type") == "error", -1.0).otherwise(1.0)
    return events.select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.format_string("user%d@example.com", "user_id").alias("user"),
        (F.col("value") * 100 * sign).alias("amount"),
    )


def trans_lines(events):
    return encode_transactions(transactions(events), IP, TRANS_PORT)


def damaged_trans_lines(events):
    """Every line, damaged in a way its event id chooses; most ways leave it readable."""
    source = events.withColumns({"way": F.col("event_id") % 10})
    line = F.format_string(
        f"{IP}|{TRANS_PORT}|%s|user%d@example.com|%s",
        F.when(F.col("way") == 3, "20130132000000").otherwise(
            F.date_format("ts", "yyyyMMddHHmmss")
        ),
        F.col("user_id"),
        F.format_string("%.2f", F.col("value") * 100),
    )
    fields = F.split(line, r"\|")
    damaged = (
        F.when(F.col("way") == 0, F.array_join(F.slice(fields, 1, 3), "|"))
        .when(F.col("way") == 1, F.concat(line, F.lit("x")))
        .when(F.col("way") == 2, F.concat(line, F.lit("d")))
        .when(F.col("way") == 4, F.array_join(F.slice(fields, 1, 4), "|"))
        .when(F.col("way") == 5, F.concat(line, F.lit("|more")))
        .when(F.col("way") == 6, F.concat(F.array_join(F.slice(fields, 1, 4), "|"), F.lit("|")))
        .otherwise(line)
    )
    return source.select(damaged.alias("value"))


def message_lines(events):
    line = delimited(
        F.lit(IP),
        F.lit(TRANS_PORT),
        F.date_format("ts", "yyyyMMddHHmmss"),
        F.col("event_type"),
    )
    return events.select(line.alias("value"))


def damaged_message_lines(events):
    """Message lines of which some lack fields or have an impossible time, by their event id."""
    way = F.col("event_id") % 5
    stamp = F.when(way == 1, F.lit("20130132000000")).otherwise(
        F.date_format("ts", "yyyyMMddHHmmss")
    )
    line = delimited(F.lit(IP), F.lit(TRANS_PORT), stamp, F.col("event_type"))
    short = F.substring_index(line, "|", 3)
    return events.select(F.when(way == 2, short).otherwise(line).alias("value"))


def header(number, name):
    """One of four header shapes: an address, names around one, repeated addresses, none."""
    shape = number % 4
    return (
        F.when(shape == 0, F.format_string("r%d@example.com", number))
        .when(shape == 1, F.format_string("%s Lee <a%d@example.com>", name, number))
        .when(
            shape == 2,
            F.format_string("a%d@example.com b%d@example.com a%d@example.com", number, number, number),
        )
        .otherwise(F.format_string("nobody %d", number))
    )


def with_phrase(documents):
    """Documents with a phrase of lexicon words appended, chosen by the document id."""
    phrases = F.array(*[F.lit(p) for p in PHRASES])
    chosen = F.get(phrases, (F.col("doc_id") % len(PHRASES)).cast("int"))
    return documents.withColumn("text", F.concat_ws(" ", "text", chosen))


def spoken(documents):
    """Documents with contractions, quotes, abbreviations and numbers in place of common words."""
    text = F.col("text")
    for word, said in SPOKEN:
        text = F.replace(text, F.lit(word), F.lit(said))
    return documents.withColumn("text", text)


def corpus(documents):
    """An email per document: the first line is the subject and the rest the content."""
    number = F.col("doc_id")
    line_end = F.instr("text", "\n")
    return documents.select(
        F.expr(f"timestamp_ntz'{START}' + make_dt_interval(0, 0, 0, doc_id * 30)").alias(
            "event_time"
        ),
        header(number + 2, F.col("lang")).alias("mailfrom"),
        header(number, F.col("source")).alias("torecipients"),
        F.substring_index("text", "\n", 1).alias("subject"),
        F.when(line_end > 0, F.expr("substring(text, instr(text, '\n') + 1)"))
        .otherwise("")
        .alias("content"),
    )


def email_lines(documents):
    return encode_emails(corpus(documents), IP, EMAIL_PORT)


def scored_email_lines(documents):
    return email_lines(with_phrase(documents))


def vocabulary(documents):
    """A lexicon of all tokens of the documents, dealt out to every class by a checksum."""
    words = documents.select(F.explode(tokens("text")).alias("token"))
    words = words.select(F.lower("token").alias("word")).distinct()
    digit = F.conv(F.substring(F.md5("word"), 1, 1), 16, 10).cast("int")
    return words.select(
        F.when(digit < 2, "sentiment").when(digit < 4, "power").when(digit == 4, "fraud")
        .otherwise("topic").alias("lexicon"),
        F.when(digit < 4, digit % 2).when(digit == 4, 1).otherwise(digit - 5).alias("class_id"),
        "word",
    )


def order_email_lines(lineitem):
    """An email per order line, from the order to the part, the supplier and invalid recipients."""
    part = F.format_string("part%d@example.com", "l_partkey")
    supplier = F.format_string("supplier%d@example.com", "l_suppkey")
    to = (
        F.when(F.col("l_linenumber") == 1, part)
        .when(F.col("l_linenumber") == 2, F.concat_ws("~", part, supplier, part))
        .when(F.col("l_linenumber") == 3, F.concat_ws("~", F.lit("nobody"), supplier))
        .when(F.col("l_linenumber") == 4, F.lit("a@b.c"))
        .when(F.col("l_linenumber") == 5, F.concat_ws("~", F.lit("a@b.cd"), F.lit("")))
        .otherwise("")
    )
    line = delimited(
        F.lit(IP),
        F.lit(EMAIL_PORT),
        F.date_format("l_shipdate", "yyyyMMddHHmmss"),
        F.format_string("order%d@example.com", "l_orderkey"),
        to,
        F.col("l_returnflag"),
    )
    # returned lines have no subject field, which leaves five fields: too few for an edge
    short = F.substring_index(line, "|", 5)
    return lineitem.select(
        F.when(F.col("l_returnflag") == "R", short).otherwise(line).alias("value")
    )

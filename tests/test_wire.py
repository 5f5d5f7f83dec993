from datetime import datetime

from pyspark.sql import functions as F

from commwatch.functions.wire import addresses, envelope, multi_value, sanitise
from commwatch.operators.emails import encode_emails, parse_emails
from commwatch.operators.validity import rejected, valid


HEADERS = [
    ("a@example.com", ["a@example.com"]),
    ("<a@example.com>", ["<a@example.com>"]),
    ("Ann Lee <a@example.com>", ["Ann", "Lee"]),
    ("a@example.com b@example.com a@example.com", ["a@example.com", "b@example.com"]),
    ("nobody", []),
    ("no body", []),
    ("", []),
    (None, []),
    ("a@example.com  b", ["a@example.com", "", "b"]),
]


def test_addresses(rows):
    frame = rows([h for h, _ in HEADERS], "h").select("h", addresses(F.col("h")).alias("a"))
    assert {r.h: r.a for r in frame.collect()} == dict(HEADERS)


def test_bracketed_addresses_on_request(rows):
    frame = rows(["Ann Lee <a@example.com>"], "h").select(addresses(F.col("h"), True))
    assert frame.collect()[0][0] == ["Ann", "Lee", "a@example.com"]


def test_multi_value_is_sorted(spark):
    frame = spark.range(1).select(multi_value(F.array(F.lit("b"), F.lit("a"))))
    assert frame.collect()[0][0] == "a~b"


def test_sanitise(rows):
    frame = rows(["a|b\r\nc"], "t").select(sanitise(F.col("t")))
    assert frame.collect()[0][0] == "a b  c"


def test_envelope_keeps_positions_of_nulls(spark):
    time = F.lit(datetime(2013, 1, 2, 3, 4, 5))
    frame = spark.range(1).select(
        envelope(F.lit("ip"), F.lit("1"), time, F.lit(None).cast("string"), F.lit("x"))
    )
    assert frame.collect()[0][0] == "ip|1|20130102030405||x"


def test_email_round_trip(spark):
    corpus = spark.createDataFrame(
        [(datetime(2013, 1, 2), "a@example.com", "b@example.com c@example.com", "s|1", "one\ntwo")],
        "event_time timestamp_ntz, mailfrom string, torecipients string, subject string, "
        "content string",
    )
    row = valid(parse_emails(encode_emails(corpus, "10.0.0.1", "1237"))).collect()[0]
    assert row.asDict() == {
        "ip": "10.0.0.1",
        "port": "1237",
        "date_time": "20130102000000",
        "fr": "a@example.com",
        "to": "b@example.com~c@example.com",
        "subject": "s 1",
        "content": "one two",
        "n_fields": 7,
    }


def test_email_arity(rows):
    lines = ["1|2|3|4|5|6", "1|2|3|4|5|6|", "1|2|3|4|5|6|7|8", ""]
    parsed = parse_emails(rows(lines))
    assert {r.content for r in valid(parsed).collect()} == {"", "7"}
    assert {r.value for r in rejected(parsed).collect()} == {"1|2|3|4|5|6", ""}

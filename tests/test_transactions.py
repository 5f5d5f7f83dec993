import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from commwatch.functions.wire import amount_text
from commwatch.operators.transactions import (
    encode_transactions,
    flag_transactions,
    parse_transactions,
)
from commwatch.operators.validity import rejected, valid

HEAD = "10.0.0.1|1235|"

FLAGS = {
    "20130107120000|u@example.com|9999.99": (0, 0, 0),
    "20130107120000|u@example.com|10000": (1, 0, 0),
    "20130107120000|u@example.com|-10000": (1, 0, 0),
    "20130106120000|u@example.com|1": (0, 1, 0),
    "20130105120000|u@example.com|1": (0, 0, 0),
    "20130107065959|u@example.com|1": (0, 0, 1),
    "20130107070000|u@example.com|1": (0, 0, 0),
    "20130107225959|u@example.com|1": (0, 0, 0),
    "20130107230000|u@example.com|1": (0, 0, 1),
    "20130132000000|u@example.com|1": (0, 0, 0),
    "2013010700000|u@example.com|1": (0, 0, 0),
    "20130107120060|u@example.com|1": (0, 0, 0),
    "|u@example.com|1": (0, 0, 0),
    "20130107120000|u@example.com|NaN": (0, 0, 0),
    "20130107120000|u@example.com|-inf": (1, 0, 0),
    "20130107120000|u@example.com| 1e5 ": (1, 0, 0),
    "20130107120000|u@example.com|1|extra|": (0, 0, 0),
}

REJECTED = {
    "20130107120000|u@example.com|12x": "bad amount",
    "20130107120000|u@example.com|1d": "bad amount",
    "20130107120000|u@example.com|1f": "bad amount",
    "20130107120000|u@example.com|1_0": "bad amount",
    "20130107120000|u@example.com|0x10": "bad amount",
    "20130107120000|u@example.com|": "bad amount",
    "20130107120000|u@example.com": "too few fields",
    "": "too few fields",
}


def test_flags(rows):
    # the number of the case takes the place of the address
    lines = [f"{i}|1235|{tail}" for i, tail in enumerate(FLAGS)]
    got = {
        int(r.ip): (r.big_trans, r.is_in_odd_day, r.is_at_odd_time)
        for r in flag_transactions(parse_transactions(rows(lines))).collect()
    }
    assert {tail: got.get(i) for i, tail in enumerate(FLAGS)} == FLAGS


def test_rejects_keep_the_line_and_say_why(rows):
    lines = [HEAD + tail for tail in REJECTED] + [None]
    parsed = parse_transactions(rows(lines))
    assert valid(parsed).count() == 0
    got = {(r.value, r.reason) for r in rejected(parsed).collect()}
    assert got == {(HEAD + t, why) for t, why in REJECTED.items()} | {(None, "too few fields")}


def test_every_line_is_valid_or_rejected(rows):
    parsed = parse_transactions(rows([HEAD + t for t in [*FLAGS, *REJECTED]]))
    assert valid(parsed).count() == len(FLAGS)
    assert rejected(parsed).count() == len(REJECTED)


def test_flag_parameters(rows):
    parsed = parse_transactions(rows([HEAD + "20130105060000|u|50"]))
    row = flag_transactions(parsed, threshold=50, odd_days=(5, 6), first_hour=6).collect()[0]
    assert (row.big_trans, row.is_in_odd_day, row.is_at_odd_time) == (1, 1, 0)


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_flags_do_not_depend_on_the_zone(spark, rows, zone):
    # 02:30 on this Sunday does not exist in New York
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        line = HEAD + "20130310023000|u|1"
        row = flag_transactions(parse_transactions(rows([line]))).collect()[0]
        assert (row.is_in_odd_day, row.is_at_odd_time) == (1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_round_trip(spark):
    source = spark.createDataFrame(
        [(datetime(2013, 1, 7, 8, 9, 10), "u@example.com", -12.5), (datetime(2013, 1, 7), None, None)],
        "event_time timestamp_ntz, user string, amount double",
    )
    lines = encode_transactions(source, "10.0.0.1", "1235")
    values = [r.value for r in lines.collect()]
    assert values[0] == "10.0.0.1|1235|20130107080910|u@example.com|-12.50"
    assert values[1].count("|") == 4
    row = valid(parse_transactions(lines)).collect()[0]
    assert (row.ip, row.user, row.amount) == ("10.0.0.1", "u@example.com", -12.5)
    assert row.event_time == datetime(2013, 1, 7, 8, 9, 10)


def test_amount_text(spark):
    frame = spark.range(1).select(amount_text(F.lit(3.14159)), amount_text(F.lit(-2.0)))
    assert tuple(frame.collect()[0]) == ("3.14", "-2.00")


def test_nan_amount_is_kept(rows):
    row = valid(parse_transactions(rows([HEAD + "20130107120000|u|+nan"]))).collect()[0]
    assert math.isnan(row.amount)

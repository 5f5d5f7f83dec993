from datetime import datetime

import pytest

from commwatch.operators.counts import (
    batch_counts,
    fourth_char_counts,
    message_counts,
    parse_messages,
    timed_messages,
)
from commwatch.operators.edges import edges
from commwatch.operators.filters import business_days, until_year
from commwatch.operators.validity import rejected, valid

RECIPIENTS = {
    "a@example.com~b@example.com": 2,
    "a@example.com~a@example.com": 2,
    "a@b.c": 0,
    "a@b.cd": 1,
    "nobody~a@example.com": 1,
    "": 0,
}


def test_recipients(rows):
    lines = [f"i|p|t|sender{i}~x|{to}|s|c" for i, to in enumerate(RECIPIENTS)]
    got = [r.fr for r in edges(rows(lines)).collect()]
    assert {to: got.count(f"sender{i}~x") for i, to in enumerate(RECIPIENTS)} == RECIPIENTS


def test_edges_need_six_fields(rows):
    lines = ["i|p|t|f|a@example.com", "i|p|t|f|a@example.com|s", None]
    assert [tuple(r) for r in edges(rows(lines)).collect()] == [("f", "a@example.com", "t")]


def test_message_counts(rows):
    lines = ["i|p|20130101000000|7", "i|p|20130101000000|7", "i|p|20130101000001|7", "i|p|bad|7",
             "i|p|20130101000000"]
    got = message_counts(timed_messages(rows(lines))).collect()
    assert {(r.window_start, r.message, r.n) for r in got} == {
        (datetime(2013, 1, 1), "7", 2),
        (datetime(2013, 1, 1, 0, 0, 1), "7", 1),
    }


@pytest.mark.parametrize("zone", ["America/New_York", "America/Sao_Paulo", "Asia/Tokyo"])
def test_counts_do_not_depend_on_the_zone(spark, rows, zone):
    """Hours that a zone skips or repeats are hours like any other here."""
    stamps = ["20130310023000", "20130310033000", "20131103013000", "20131020003000", "20131020013000"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = message_counts(timed_messages(rows([f"i|p|{s}|7" for s in stamps]))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert sorted((r.window_start.strftime("%Y%m%d%H%M%S"), r.n) for r in got) == sorted(
        (s, 1) for s in stamps
    )


def test_every_line_is_counted_or_rejected(rows):
    parsed = parse_messages(rows(["i|p|20130101000000|7", "i|p|bad|7", "i|p|20130101000000", None]))
    assert valid(parsed).count() == 1
    assert sorted(r.reason for r in rejected(parsed).collect()) == ["bad time", "too few fields", "too few fields"]


def test_fourth_character_of_every_field(rows):
    got = fourth_char_counts(rows(["abcd|abc|xyzd", "", None, "1234"])).collect()
    assert {r.character: r.n for r in got} == {"d": 2, "4": 1}


def times(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "event_time timestamp_ntz")


def test_batch_counts(spark):
    frame = times(spark, datetime(2013, 1, 1), datetime(2013, 1, 1, 0, 0, 0, 999_999),
                  datetime(2013, 1, 1, 0, 0, 1))
    assert sorted(r.n for r in batch_counts(frame).collect()) == [1, 2]


def test_filters(spark):
    frame = times(spark, datetime(2013, 1, 4), datetime(2013, 1, 5), datetime(2013, 1, 6),
                  datetime(2015, 12, 31, 23, 59), datetime(2016, 1, 1))
    assert business_days(frame, "event_time").count() == 4
    assert business_days(frame, "event_time", (5, 6)).count() == 3
    assert until_year(frame, "event_time").count() == 4
    assert until_year(frame, "event_time", 2013).count() == 3

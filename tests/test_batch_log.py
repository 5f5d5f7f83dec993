"""Batches that count all together, are merged and run again."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from commwatch.functions.lexicons import lexicon_table
from commwatch.operators.counts import message_counts, timed_messages
from commwatch.operators.edges import edges
from commwatch.operators.emails import parse_emails, score_emails
from commwatch.plans.samples import FRAUD, POWER, SAMPLES, SENTIMENT, TOPIC
from commwatch.schemas import EMAIL_GRAPH, EMAIL_STREAM, REJECTED
from commwatch.sources.lines import admission, stream_lines
from commwatch.streaming import jobs
from commwatch.streaming.batch_log import BatchLog, LoggedSink, log_of
from commwatch.streaming.sinks import FolderSink

PARTS = [
    [f"i|p|2013010{d}000000|f{d}{k}|a@example.com~b{k}@example.com|Gas deal|fraud {k}" for k in range(5)]
    + [f"short{d}"]
    for d in (1, 2, 3)
]
LINES = [line for part in PARTS for line in part]


def texts(frame):
    return sorted(map(repr, frame.collect()))


class Feed:
    """A folder of lines to which parts are added; each run of a job takes in the new ones."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        (folder / "lines").mkdir()

    def add(self, name, lines):
        (self.folder / "lines" / f"{name}.txt").write_text("\n".join(lines) + "\n")

    def lines(self):
        return stream_lines(self.spark, "text", path=f"{self.folder}/lines")


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


@pytest.fixture
def log(tmp_path):
    return BatchLog(f"{tmp_path}/log")


def email_job(feed, log, graph=None, lexicons=SAMPLES):
    return jobs.start_emails(
        feed.lines(), log.sink("emails"), graph or log.sink("graph"), log.sink("rejected"),
        f"{feed.folder}/checkpoint", jobs.ONCE, lexicons=lexicons,
    )


def seen(spark, log):
    graph = log.sink("graph").read(spark, EMAIL_GRAPH).drop("job", "batch_id")
    emails = log.sink("emails").read(spark, EMAIL_STREAM).select(*EMAIL_STREAM.names)
    return texts(emails), texts(graph), log.sink("rejected").read(spark, REJECTED).count()


def expected(rows, lines):
    parsed = parse_emails(rows(lines))
    return texts(score_emails(parsed, SAMPLES)), texts(edges(rows(lines))), sum("|" not in x for x in lines)


def test_batches_show_in_all_sinks_or_in_none(spark, rows, feed, log):
    class Broken(LoggedSink):
        def write(self, batch, batch_id, job, attempt):
            raise RuntimeError("disk full")

    feed.add("0", PARTS[0])
    email_job(feed, log).awaitTermination()
    feed.add("1", PARTS[1])
    with pytest.raises(Exception, match="disk full"):
        email_job(feed, log, graph=Broken(log, "graph")).awaitTermination()
    # the emails of the failed batch were written, but nothing of it counts
    assert spark.read.parquet(f"{log.path}/emails/loose").count() == 10
    assert seen(spark, log) == expected(rows, PARTS[0])
    email_job(feed, log).awaitTermination()
    assert seen(spark, log) == expected(rows, PARTS[0] + PARTS[1])


def test_rows_are_equal_before_during_and_after_compaction(spark, rows, feed, log, monkeypatch):
    graph = log.sink("graph")
    for name, part in enumerate(PARTS):
        feed.add(name, part)
        email_job(feed, log).awaitTermination()
    want = expected(rows, LINES)
    assert seen(spark, log) == want
    job = log.batches(spark).first().job
    # a compaction that stops before its manifest leaves rows that do not count
    with monkeypatch.context() as broken:
        broken.setattr("commwatch.streaming.batch_log.KEY", ("missing",))
        with pytest.raises(Exception):
            graph.compact(spark, EMAIL_GRAPH)
    assert seen(spark, log) == want
    assert graph.compact(spark, EMAIL_GRAPH) == 2
    assert seen(spark, log) == want
    # the same batch again, from an old checkpoint and with other rows, after it was merged
    again = edges(rows(PARTS[0] + PARTS[0]))
    graph.write(again, 0, job, "second")
    assert seen(spark, log) == want
    log.commit(spark, job, 0, "second", {"graph": 20})
    assert graph.read(spark, EMAIL_GRAPH).where("batch_id = 0").count() == 20
    assert graph.read(spark, EMAIL_GRAPH).count() == 40
    assert graph.compact(spark, EMAIL_GRAPH) == 1 and graph.compact(spark, EMAIL_GRAPH) == 0
    assert graph.read(spark, EMAIL_GRAPH).count() == 40


def test_vacuum_and_merged_records_keep_the_rows(spark, rows, feed, log):
    for name, part in enumerate(PARTS):
        feed.add(name, part)
        email_job(feed, log).awaitTermination()
    want, counts = seen(spark, log), texts(log.rows_of(spark))
    graph = log.sink("graph")
    graph.compact(spark, EMAIL_GRAPH)
    job = log.batches(spark).first().job
    graph.write(edges(rows(PARTS[0])), 7, job, "running")  # of a batch that is not committed yet
    assert graph.vacuum(spark) == 2
    assert log.compact(spark) == 2 and log.compact(spark) == 0
    assert seen(spark, log) == want and texts(log.rows_of(spark)) == counts
    # loose: the last batch and the running one
    assert spark.read.parquet(f"{graph.path}/loose").select("batch_id").distinct().count() == 2
    # a batch whose record was merged, run again and merged again
    for rows_again, attempt in ((PARTS[0] * 2, "x"), (PARTS[0] * 3, "y")):
        graph.write(edges(rows(rows_again)), 0, job, attempt)
        log.commit(spark, job, 0, attempt, {})
        log.compact(spark)
        assert graph.read(spark, EMAIL_GRAPH).where("batch_id = 0").count() == 2 * len(rows_again) // 6 * 5


def test_rows_of_each_batch_are_counted(spark, feed, log):
    for name, part in enumerate(PARTS):
        feed.add(name, part)
        email_job(feed, log).awaitTermination()
    counted = {(r.batch_id, r.sink): r.n for r in log.rows_of(spark).collect()}
    assert counted == {
        (b, sink): n for b in range(3) for sink, n in (("emails", 5), ("graph", 10), ("rejected", 1))
    }


def test_emails_by_table_as_by_look_up(spark, rows, feed, log):
    table = lexicon_table(spark, TOPIC, SENTIMENT, POWER, FRAUD)
    for name, part in enumerate(PARTS):
        feed.add(name, part)
        email_job(feed, log, lexicons=table).awaitTermination()
    assert seen(spark, log) == expected(rows, LINES)


def ledger(feed, log, **options):
    jobs.start_message_ledger(
        feed.lines(), log, f"{feed.folder}/checkpoint", jobs.ONCE, **options
    ).awaitTermination()


def test_counted_rejected_and_late_lines_are_the_input(spark, rows, feed, log):
    parts = [
        ["i|p|20130103000000|7", "i|p|20130103000000|7", "i|p|bad|7", "x"],
        ["i|p|20130101000000|7", "i|p|20130102235500|8", "i|p|20130102234959|9", "i|p|20130104000000|7"],
        ["i|p|20130103000000|7", "i|p|20130104000000|8"],
    ]
    for name, part in enumerate(parts):
        feed.add(name, part)
        ledger(feed, log)  # a restart before each batch
    counts = jobs.ledger_counts(spark, log)
    lost = log.sink("rejected").read(spark, REJECTED)
    reasons = {(r.value, r.reason) for r in lost.collect()}
    assert reasons == {
        ("i|p|bad|7", "bad time"), ("x", "too few fields"), ("i|p|20130101000000|7", "late"),
        ("i|p|20130102234959|9", "late"), ("i|p|20130103000000|7", "late"),
    }
    assert counts.agg(F.sum("n")).first()[0] + lost.count() == sum(map(len, parts))
    kept = ["i|p|20130103000000|7"] * 2 + ["i|p|20130102235500|8", "i|p|20130104000000|7", "i|p|20130104000000|8"]
    assert texts(counts) == texts(message_counts(timed_messages(rows(kept))))


def test_a_batch_of_the_ledger_run_again_is_late_for_the_same_lines(spark, feed, log):
    feed.add("0", ["i|p|20130103000000|7"])
    ledger(feed, log)
    feed.add("1", ["i|p|20130101000000|7", "i|p|20130105000000|7"])
    ledger(feed, log)
    before = texts(log.sink("rejected").read(spark, REJECTED).drop("job"))
    # Spark forgets that the second batch was done, as after a crash at its end
    for name in ("1", ".1.crc"):
        (feed.folder / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    ledger(feed, log)
    assert texts(log.sink("rejected").read(spark, REJECTED).drop("job")) == before
    assert jobs.ledger_counts(spark, log).agg(F.sum("n")).first()[0] == 2


def test_an_empty_ledger(spark, log):
    assert jobs.ledger_counts(spark, log).count() == 0 and log.batches(spark).count() == 0
    assert log.sink("counts").vacuum(spark) == 0 and log.compact(spark) == 0


def test_sinks_of_a_job_share_one_log(tmp_path):
    one, other = BatchLog(f"{tmp_path}/a"), BatchLog(f"{tmp_path}/b")
    assert log_of([one.sink("x"), one.sink("y")]) == one
    assert log_of([FolderSink("x"), FolderSink("y")]) is None
    for mixed in ([one.sink("x"), other.sink("y")], [one.sink("x"), FolderSink("y")]):
        with pytest.raises(ValueError, match="one log"):
            log_of(mixed)


def test_admission():
    assert admission("text") == {"maxFilesPerTrigger": "1000"}
    assert admission("text", size="1g") == {"maxBytesPerTrigger": "1g"}
    assert admission("kafka", rows=5) == {"maxOffsetsPerTrigger": "5"}
    assert admission("socket") == {}
    for source, limits in (("socket", {"rows": 1}), ("kafka", {"files": 1}), ("text", {"files": 1, "size": 1})):
        with pytest.raises(ValueError):
            admission(source, **limits)


@pytest.mark.parametrize("limits, batches", [({"files": 1}, 3), ({"files": 2}, 2), ({"size": 1}, 3), ({}, 1)])
def test_limits_bound_a_batch(spark, feed, log, limits, batches):
    for name, part in enumerate(PARTS):
        feed.add(name, part)
    lines = stream_lines(spark, "text", path=f"{feed.folder}/lines", **limits)
    jobs.start_edges(
        lines, log.sink("graph"), log.sink("rejected"), f"{feed.folder}/checkpoint", jobs.ONCE
    ).awaitTermination()
    assert log.batches(spark).count() == batches
    assert log.sink("graph").read(spark, EMAIL_GRAPH).count() == 30


def test_reading_a_sink_deals_out_no_rows(spark, log):
    """Rows dealt out by their batch would all meet in one task: only names of batches move."""
    sink = log.sink("emails")
    for batch_id in range(3):
        sink.write(spark.range(40).select(F.lit("i").alias("fr")), batch_id, "job", f"a{batch_id}")
        log.commit(spark, "job", batch_id, f"a{batch_id}", {"emails": 40})
    schema = StructType([StructField("fr", StringType())])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = sink.read(spark, schema)
        plan = read._jdf.queryExecution().executedPlan().toString()
        # the rows are joined where they are read
        assert re.search(r"BroadcastHashJoin [^\n]*LeftSemi[^\n]*\n[ :+-]*FileScan parquet \[fr", plan)
        assert read.count() == 120
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

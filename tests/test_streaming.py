import os

import pytest
from pyspark.sql import functions as F

from commwatch.operators.counts import message_counts, timed_messages
from commwatch.operators.edges import edges
from commwatch.operators.emails import parse_emails, score_emails
from commwatch.operators.transactions import flag_transactions, parse_transactions
from commwatch.plans.samples import SAMPLES
from commwatch.schemas import EMAIL_GRAPH, EMAIL_STREAM, LINES, REJECTED, SINK_TABLES, TRANS_STREAM
from commwatch.sources.lines import stream_lines
from commwatch.sources.tables import stream_table
from commwatch.streaming import jobs
from commwatch.streaming.sinks import FolderSink, TableSink, latest, reset_tables

TRANS = [f"ip|p|201301{6 + i % 2:02d}{i % 24:02d}0000|u{i}|{i * 500}" for i in range(60)]
TRANS += ["too|few", "ip|p|20130106000000|u|1d"]
EMAILS = [f"ip|p|20130101{i:06d}|f{i}|a@example.com~b{i}@example.com|Gas deal|fraud {i}"
          for i in range(20)]
EMAILS += ["i|p|t|f|a@example.com|s", "short"]
MESSAGES = [f"ip|p|2013010100{i % 3:02d}00|{i % 4}" for i in range(50)]


def same(left, right):
    assert sorted(map(repr, left.collect())) == sorted(map(repr, right.collect()))


@pytest.fixture
def source(spark, tmp_path):
    """A stream over three text files, one a batch."""
    def make(lines):
        folder = tmp_path / "lines"
        folder.mkdir()
        for i in range(3):
            (folder / f"{i}.txt").write_text("\n".join(lines[i::3]) + "\n")
        return stream_lines(spark, "text", path=str(folder), maxFilesPerTrigger=1)

    return make


def test_transactions_as_in_batch(spark, rows, source, tmp_path):
    sink, rejects = FolderSink(f"{tmp_path}/trans"), FolderSink(f"{tmp_path}/rejected")
    jobs.start_transactions(
        source(TRANS), sink, rejects, f"{tmp_path}/checkpoint", jobs.ONCE, threshold=5000
    ).awaitTermination()
    written = sink.read(spark, TRANS_STREAM)
    assert {r.batch_id for r in written.select("batch_id").distinct().collect()} == {0, 1, 2}
    expected = flag_transactions(parse_transactions(rows(TRANS)), threshold=5000)
    same(written.drop("job", "batch_id"), expected)
    assert rejects.read(spark, REJECTED).count() == 2


def test_restart_adds_only_new_files(spark, source, tmp_path):
    lines = source(TRANS)
    sink, rejects = FolderSink(f"{tmp_path}/trans"), FolderSink(f"{tmp_path}/rejected")

    def run():
        jobs.start_transactions(
            lines, sink, rejects, f"{tmp_path}/checkpoint", jobs.ONCE
        ).awaitTermination()
        return sink.read(spark, TRANS_STREAM).count()

    assert run() == 60
    assert run() == 60
    (tmp_path / "lines" / "late.txt").write_text(TRANS[0] + "\n")
    assert run() == 61


def test_replayed_batch_replaces_its_rows(spark, rows, tmp_path):
    frame = flag_transactions(parse_transactions(rows(TRANS)))
    for sink in (FolderSink(f"{tmp_path}/trans"), TableSink("default.trans_stream")):
        reset_tables(spark, tables=("trans_stream",))
        sink.write(frame, 0, "a")
        sink.write(frame, 1, "a")
        seen = sink.read(spark, TRANS_STREAM)
        assert seen.count() == 120
        sink.write(frame.select(*reversed(frame.columns)), 1, "a")
        assert sink.read(spark, TRANS_STREAM).count() == 120
        sink.write(frame, 1, "b")
        assert sink.read(spark, TRANS_STREAM).count() == 180
        same(sink.read(spark, TRANS_STREAM).where("job = 'a' AND batch_id = 1").drop("job", "batch_id"), frame)


def test_jobs_and_checkpoints_keep_their_rows_in_a_shared_sink(spark, source, tmp_path):
    lines, rejects = source(TRANS + EMAILS), FolderSink(f"{tmp_path}/rejected")
    trans, graph = FolderSink(f"{tmp_path}/trans"), FolderSink(f"{tmp_path}/graph")

    def run(name):
        jobs.start_transactions(
            lines, trans, rejects, f"{tmp_path}/{name}-trans", jobs.ONCE
        ).awaitTermination()
        jobs.start_edges(
            lines, graph, rejects, f"{tmp_path}/{name}-edges", jobs.ONCE
        ).awaitTermination()
        return [s.read(spark, k).count() for s, k in ((trans, TRANS_STREAM), (graph, EMAIL_GRAPH), (rejects, REJECTED))]

    first = run("one")
    assert first[2] > 62  # the transaction job alone rejects the emails and two more
    assert run("one") == first  # nothing new under the same checkpoint
    assert run("two") == [2 * n for n in first]


def test_uncountable_messages_are_kept(spark, source, tmp_path):
    lines = source([*MESSAGES, "i|p|bad|7", "i|p|20130101000000", "x"])
    rejects = FolderSink(f"{tmp_path}/rejected")
    jobs.start_message_rejects(lines, rejects, f"{tmp_path}/checkpoint", jobs.ONCE).awaitTermination()
    got = {(r.value, r.reason) for r in rejects.read(spark, REJECTED).collect()}
    assert got == {("i|p|bad|7", "bad time"), ("i|p|20130101000000", "too few fields"), ("x", "too few fields")}


def test_late_messages_are_told(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    for i, day in enumerate(("03", "01", "04")):
        (tmp_path / "lines" / f"{i}.txt").write_text(f"i|p|201301{day}000000|7\n")
        os.utime(tmp_path / "lines" / f"{i}.txt", (i + 1, i + 1))
    lines = stream_lines(spark, "text", path=f"{tmp_path}/lines", maxFilesPerTrigger=1)
    sink = FolderSink(f"{tmp_path}/counts")
    query = jobs.start_message_counts(lines, sink, f"{tmp_path}/checkpoint", jobs.ONCE)
    query.awaitTermination()
    schema = message_counts(timed_messages(lines)).schema
    assert sink.read(spark, schema).count() + jobs.late_messages(query) == 3


def test_emails_and_edges_from_one_stream(spark, rows, source, tmp_path):
    reset_tables(spark)
    emails, graph = TableSink("default.email_stream"), TableSink("default.email_graph")
    rejects = TableSink("default.rejected")
    jobs.start_emails(
        source(EMAILS), emails, graph, rejects, f"{tmp_path}/checkpoint", jobs.ONCE, lexicons=SAMPLES
    ).awaitTermination()
    same(emails.read(spark).select(*EMAIL_STREAM.names), score_emails(parse_emails(rows(EMAILS)), SAMPLES))
    same(graph.read(spark).select(*EMAIL_GRAPH.names), edges(rows(EMAILS)))
    # six fields are enough for an edge and too few for an email
    assert graph.read(spark).count() == 41 and rejects.read(spark).count() == 2


def test_a_batch_of_more_tasks_than_cores_is_dealt_evenly(spark, rows, tmp_path, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)  # less than opening a file: one a task
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.files.maxPartitionBytes"))
    cores = spark.sparkContext.defaultParallelism
    lines = [f"ip|p|20130101{i:06d}|f{i}|b{i}@example.com|Gas deal|fraud {i}" for i in range(640)]
    rows(lines).repartition(cores + 1).write.parquet(f"{tmp_path}/lines")
    emails, graph, rejects = (FolderSink(f"{tmp_path}/{name}") for name in ("emails", "graph", "rejected"))
    jobs.start_emails(
        stream_table(spark, f"{tmp_path}/lines", LINES), emails, graph, rejects, f"{tmp_path}/checkpoint",
        jobs.ONCE, lexicons=SAMPLES,
    ).awaitTermination()
    written = emails.read(spark, EMAIL_STREAM)
    same(written.select(*EMAIL_STREAM.names), score_emails(parse_emails(rows(lines)), SAMPLES))
    same(graph.read(spark, EMAIL_GRAPH).drop("job", "batch_id"), edges(rows(lines)))
    per_task = written.groupBy(F.input_file_name()).count().collect()
    assert len(per_task) == 4 * cores and max(r["count"] for r in per_task) <= 2 * 640 / (4 * cores)


def test_edges_only(spark, rows, source, tmp_path):
    sink, rejects = FolderSink(f"{tmp_path}/graph"), FolderSink(f"{tmp_path}/rejected")
    jobs.start_edges(source(EMAILS), sink, rejects, f"{tmp_path}/checkpoint", jobs.ONCE).awaitTermination()
    assert [r.value for r in rejects.read(spark, REJECTED).collect()] == ["short"]
    same(sink.read(spark, EMAIL_GRAPH).drop("job", "batch_id"), edges(rows(EMAILS)))


def test_message_counts_as_in_batch(spark, rows, source, tmp_path):
    sink = FolderSink(f"{tmp_path}/counts")
    jobs.start_message_counts(
        source(MESSAGES), sink, f"{tmp_path}/checkpoint", jobs.ONCE
    ).awaitTermination()
    expected = message_counts(timed_messages(rows(MESSAGES)))
    same(latest(sink.read(spark, expected.schema), "window_start", "message"), expected)


def test_failed_batch_stops_the_query(source, tmp_path):
    class Broken:
        def write(self, batch, batch_id, job):
            raise RuntimeError("disk full")

    query = jobs.start_edges(source(EMAILS), Broken(), Broken(), f"{tmp_path}/checkpoint", jobs.ONCE)
    with pytest.raises(Exception, match="disk full"):
        query.awaitTermination()


def test_empty_source_writes_nothing(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    sink = FolderSink(f"{tmp_path}/graph")
    lines = stream_lines(spark, "text", path=f"{tmp_path}/lines")
    jobs.start_edges(lines, sink, sink, f"{tmp_path}/checkpoint", jobs.ONCE).awaitTermination()
    assert sink.read(spark, EMAIL_GRAPH).count() == 0


def test_reset_tables(spark):
    reset_tables(spark)
    for name, schema in SINK_TABLES.items():
        table = spark.table(f"default.{name}")
        assert table.columns == [*schema.names, "job", "batch_id"]
        assert table.count() == 0


def test_console(source, tmp_path):
    query = jobs.start_console(source(MESSAGES), f"{tmp_path}/checkpoint", jobs.ONCE)
    query.awaitTermination()
    assert query.exception() is None
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(MESSAGES)


def test_default_interval(source, tmp_path):
    query = jobs.start_console(source(MESSAGES), f"{tmp_path}/checkpoint")
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()

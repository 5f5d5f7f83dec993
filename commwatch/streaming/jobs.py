"""The surveillance pipelines on a stream of lines.

Each ``start_*`` function returns a running ``StreamingQuery``. The transforms are those of batch
input. A batch that fails stops the query, which replays it from the checkpoint when started again.
"""

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from commwatch.functions.parsing import utc_instant, utc_wall_clock
from commwatch.operators.counts import message_counts, parse_messages, timed_messages
from commwatch.operators.edges import edges_of, rejected_edges
from commwatch.operators.email_lexicon_join import (
    email_class_sets,
    email_heavy_words,
    email_table_scorer,
)
from commwatch.operators.emails import email_scorer, parse_emails
from commwatch.operators.lexicon_join import kept_words
from commwatch.operators.transactions import flag_transactions, parse_transactions
from commwatch.operators.validity import rejected, valid
from commwatch.schemas import EMAIL_STREAM, MESSAGE_COUNTS
from commwatch.sources.spreading import deal, spread
from commwatch.streaming.batch_log import log_of
from commwatch.streaming.sinks import job_of

INTERVAL = {"processingTime": "1 second"}
ONCE = {"availableNow": True}
DELAY = "10 minutes"
LATE = "late"


def _start(stream, write_batch, checkpoint, trigger, mode="append"):
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or INTERVAL))
        .foreachBatch(write_batch)
        .start()
    )


def _write_outputs(prepared, outputs, batch_id, job, newest=None):
    """Write several results of a batch, each to its sink, and last the record in their log."""
    log = log_of([sink for _, sink in outputs])
    if log is None:
        if not prepared.isEmpty():
            for transform, sink in outputs:
                sink.write(transform(prepared), batch_id, job)
        return
    attempt, seen = uuid.uuid4().hex, {}
    for transform, sink in outputs:
        seen[sink.name] = Observation()
        counted = transform(prepared).observe(seen[sink.name], F.count(F.lit(1)).alias("n"))
        sink.write(counted, batch_id, job, attempt)
    rows = {name: one.get["n"] for name, one in seen.items()}
    log.commit(prepared.sparkSession, job, batch_id, attempt, rows, newest)


def _write_each(prepare, outputs, spread=spread):
    """A batch function that prepares its input once and writes several results of it.

    ``outputs`` are pairs of a transform and a sink, and ``spread`` deals the input out. Sinks of one
    log show a batch all together or not at all; sinks without a log skip a batch without rows.
    """
    log_of([sink for _, sink in outputs])

    def write(batch, batch_id):
        prepared = prepare(spread(batch)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _write_outputs(prepared, outputs, batch_id, job_of(batch))
        finally:
            prepared.unpersist()

    return write


def start_transactions(lines, sink, rejects, checkpoint, trigger=None, **flag_options):
    """Flagged transactions to ``sink``, malformed lines to ``rejects``."""
    outputs = [(lambda parsed: flag_transactions(parsed, **flag_options), sink), (rejected, rejects)]
    return _start(lines, _write_each(parse_transactions, outputs), checkpoint, trigger)


def _scored_by_table(lexicons, **options):
    """A transform that scores a batch of valid emails by a lexicon table.

    The words are cached as the join wants them, for as long as the session lasts, so that a batch
    shuffles no lexicon. Which words are heavy is counted on the first batch with emails and kept:
    it decides how rows are dealt out, not what they score.
    """
    words = kept_words(email_class_sets(lexicons))
    heavy = []

    def score(emails):
        if not heavy and not emails.isEmpty():
            heavy.append(email_heavy_words(emails, **options))
        return email_table_scorer(words, heavy=heavy[0] if heavy else (), **options)(emails)

    return score


def start_emails(
    lines, email_sink, graph_sink, rejects, checkpoint, trigger=None, *, lexicons, **options
):
    """Scored emails, edges and malformed lines of one stream, each to its sink.

    ``lexicons`` are ``Lexicons``, which score within the row, or a table ``(lexicon, class_id,
    word)`` of any size, which is joined. A batch is parsed and scored once; each output is then a
    projection of the persisted result. The raw text is kept for malformed lines alone. Large batches
    that are scored within the row are dealt out evenly, as scoring is nearly all of the work.
    """
    by_table = isinstance(lexicons, DataFrame)
    score = (_scored_by_table if by_table else email_scorer)(lexicons, **options)

    def prepare(batch):
        parsed = parse_emails(batch)
        raw = F.when(F.col("reason").isNotNull(), F.col("value"))
        parsed = parsed.withColumn("value", raw)
        return parsed if by_table else score(parsed)

    def emails(prepared):
        scored = score(valid(prepared)) if by_table else valid(prepared)
        return scored.select(*EMAIL_STREAM.fieldNames())

    outputs = [(emails, email_sink), (edges_of, graph_sink), (rejected, rejects)]
    write = _write_each(prepare, outputs, spread if by_table else deal)
    return _start(lines, write, checkpoint, trigger)


def start_edges(lines, graph_sink, rejects, checkpoint, trigger=None):
    """Edges to ``graph_sink``; lines too short to give any to ``rejects``."""
    outputs = [(edges_of, graph_sink), (rejected_edges, rejects)]
    return _start(lines, _write_each(parse_emails, outputs), checkpoint, trigger)


def start_message_ledger(lines, log, checkpoint, trigger=None, delay=DELAY, window="1 second"):
    """Message counts per window of each batch, and every line that was not counted.

    The sinks ``counts`` and ``rejected`` of the log hold them. A line is late if its window ended
    ``delay`` or more before the newest time of the batches before its own; it is rejected like
    lines without a usable time or message, so that counted and rejected lines add up to the input.
    There is no state but the log: ``ledger_counts`` adds up the counts of the batches, and a batch
    that is run again finds the same earlier batches.
    """
    def write(batch, batch_id):
        spark, job = batch.sparkSession, job_of(batch)
        newest = log.newest_before(spark, job, batch_id)
        parsed = parse_messages(spread(batch))
        if newest is not None:
            mark = F.lit(str(newest)).cast("timestamp_ntz") - F.expr(f"INTERVAL '{delay}'")
            # windows drop rows without a time, and these are rejected for that
            timed = F.coalesce("event_time", F.lit(str(newest)).cast("timestamp_ntz"))
            parsed = parsed.withColumn("end", F.window(timed, window)["end"])
            late = F.when(F.col("end") <= mark, F.lit(LATE))
            parsed = parsed.withColumn("reason", F.coalesce("reason", late)).drop("end")
        prepared = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            last = prepared.agg(F.max("event_time").alias("last")).first().last
            reached = max((t for t in (newest, last) if t is not None), default=None)
            outputs = [
                (lambda p: message_counts(valid(p), window), log.sink("counts")),
                (rejected, log.sink("rejected")),
            ]
            _write_outputs(prepared, outputs, batch_id, job, reached)
        finally:
            prepared.unpersist()

    return _start(lines, write, checkpoint, trigger)


def ledger_counts(spark, log):
    """The counts of all batches of a message ledger added up."""
    counts = log.sink("counts").read(spark, MESSAGE_COUNTS)
    return counts.groupBy("window_start", "message").agg(F.sum("n").alias("n"))


def _streamed_counts(lines, delay, window):
    """Counts under a watermark, which takes instants only: times on the clock are read as UTC."""
    timed = timed_messages(lines).withColumn("event_time", utc_instant(F.col("event_time")))
    counts = message_counts(timed.withWatermark("event_time", delay), window)
    return counts.withColumn("window_start", utc_wall_clock(F.col("window_start")))


def start_message_counts(
    lines, sink, checkpoint, trigger=None, delay=DELAY, window="1 second"
):
    """Message counts per window as updates: each batch holds the counts it changed.

    The watermark bounds the state: a message later than ``delay`` behind the newest is not
    counted, and ``late_messages`` tells how many were not. ``latest`` reduces the updates to the
    final counts. Lines that cannot be counted at all are the business of ``start_message_rejects``.
    """
    counts = _streamed_counts(lines, delay, window)

    def write(batch, batch_id):
        sink.write(batch, batch_id, job_of(batch))

    return _start(counts, write, checkpoint, trigger, mode="update")


def start_message_rejects(lines, rejects, checkpoint, trigger=None):
    """Lines without a usable time or message to ``rejects``, as ``start_message_counts`` skips them."""
    return _start(lines, _write_each(parse_messages, [(rejected, rejects)]), checkpoint, trigger)


def late_messages(query):
    """Rows that a query's watermark has dropped so far, by its recent progress reports."""
    operators = (o for p in query.recentProgress for o in p.get("stateOperators", []))
    return sum(o.get("numRowsDroppedByWatermark", 0) for o in operators)


def start_console(lines, checkpoint, trigger=None, rows=10, window="1 second", delay=DELAY):
    """Ten of the message counts of each batch to the console."""
    counts = _streamed_counts(lines, delay, window)
    return (
        counts.writeStream.outputMode("update")
        .format("console")
        .option("numRows", rows)
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or INTERVAL))
        .start()
    )

"""Named queries ``(spark, sf_dir) -> DataFrame``."""

from pyspark.sql import functions as F

from commwatch.functions import scoring
from commwatch.functions.lexicons import TOPIC, lexicon_table
from commwatch.functions.sentences import sentence_tokens
from commwatch.functions.text import counts_json, token_counts, tokens, total_tokens
from commwatch.functions.wire import addresses, amount_text, sanitise
from commwatch.operators.counts import (
    batch_counts,
    fourth_char_counts,
    message_counts,
    parse_messages,
    timed_messages,
)
from commwatch.operators.edges import edges
from commwatch.operators.email_lexicon_join import score_emails_by_table
from commwatch.operators.emails import encode_emails, parse_emails, score_emails, score_text
from commwatch.operators.filters import business_days, people, until_year
from commwatch.operators.lexicon_join import hits_by_join
from commwatch.operators.transactions import flag_transactions, parse_transactions
from commwatch.operators.validity import rejected, valid
from commwatch.plans import inputs
from commwatch.plans.inputs import table
from commwatch.plans.samples import FRAUD, POWER, SAMPLES, SENTIMENT
from commwatch.schemas import (
    EMAIL_CORPUS,
    EMAIL_GRAPH,
    EMAIL_STREAM,
    MESSAGE_COUNTS,
    REJECTED,
    TRANS_STREAM,
)
from commwatch.session import shared_dir, stored
from commwatch.sources.spreading import spread
from commwatch.sources.tables import read_emails
from commwatch.streaming import jobs
from commwatch.streaming.batch_log import BatchLog
from commwatch.streaming.sinks import FolderSink, latest

LAST_ORDER_YEAR = 1998
TIME_TEXT = "yyyy-MM-dd HH:mm:ss"

CATALOG = {}


def query(name):
    def register(function):
        CATALOG[name] = function
        return function

    return register


def _time_text(column):
    return F.date_format(column, TIME_TEXT).alias(column)


# --- sources and encoding


@query("people_filter")
def people_filter(spark, sf_dir):
    words = (
        table(spark, sf_dir, "documents")
        .where(F.col("text").contains("@"))
        .select(
            F.explode(
                F.filter(F.split("text", r"[ \t\r\n]+"), lambda word: word.contains("@"))
            ).alias("address")
        )
    )
    return people(words).distinct()


@query("wire_trans")
def wire_trans(spark, sf_dir):
    return inputs.trans_lines(table(spark, sf_dir, "events"))


@query("wire_email")
def wire_email(spark, sf_dir):
    lines = _email_lines(spark, sf_dir)
    return lines.select(F.md5("value").alias("line_md5"))


@query("wire_corpus")
def wire_corpus(spark, sf_dir):
    """A stored email corpus, read and encoded as if sent at one time."""
    corpus = inputs.corpus(table(spark, sf_dir, "documents")).select(*EMAIL_CORPUS.fieldNames())
    folder = shared_dir(spark, "corpus")
    corpus.write.parquet(folder)
    sent = F.lit(inputs.START).cast("timestamp_ntz")
    emails = spread(read_emails(spark, folder)).withColumn("event_time", sent)
    lines = encode_emails(emails, inputs.IP, inputs.EMAIL_PORT)
    return lines.select(F.md5("value").alias("line_md5"))


@query("wire_amounts")
def wire_amounts(spark, sf_dir):
    """Amounts in sixteenths, negative for odd lines: halves of a cent are rounded away from zero."""
    sign = F.when(F.col("l_linenumber") % 2 == 1, -1.0).otherwise(1.0)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", amount_text(sign * F.col("l_quantity") / 16).alias("amount")
    )


@query("sanitise_text")
def sanitise_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(sanitise(F.col("text"))).alias("text_md5")
    )


@query("address_normalise")
def address_normalise(spark, sf_dir):
    header = inputs.header(F.col("c_custkey"), F.col("c_name"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.explode(addresses(header)).alias("address")
    )


# --- transactions


def _parsed_transactions(spark, sf_dir):
    return parse_transactions(inputs.trans_lines(table(spark, sf_dir, "events")))


@query("parse_trans")
def parse_trans(spark, sf_dir):
    return valid(_parsed_transactions(spark, sf_dir)).select(
        "ip", "port", "date_time", "user", "amount", _time_text("event_time")
    )


@query("trans_flags")
def trans_flags(spark, sf_dir):
    return flag_transactions(_parsed_transactions(spark, sf_dir))


@query("reject_trans")
def reject_trans(spark, sf_dir):
    return rejected(
        parse_transactions(inputs.damaged_trans_lines(table(spark, sf_dir, "events")))
    )


@query("tolerant_flags")
def tolerant_flags(spark, sf_dir):
    """The damaged lines that are still usable, among them those with an impossible time."""
    return flag_transactions(
        parse_transactions(inputs.damaged_trans_lines(table(spark, sf_dir, "events")))
    )


@query("business_days")
def business_days_events(spark, sf_dir):
    return business_days(table(spark, sf_dir, "events"), "ts").select("event_id", "user_id")


@query("horizon")
def horizon_orders(spark, sf_dir):
    return until_year(table(spark, sf_dir, "orders"), "o_orderdate", LAST_ORDER_YEAR).select(
        "o_orderkey", "o_custkey"
    )


# --- tokens


def _documents(spark, sf_dir):
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _email_lines(spark, sf_dir, encode=inputs.email_lines):
    return encode(spread(table(spark, sf_dir, "documents").drop("n_chars")))


def _spoken(spark, sf_dir):
    return inputs.spoken(_documents(spark, sf_dir))


def _count_rows(spark, sf_dir, reset):
    # exploding the expression itself: for a column of an earlier projection Catalyst would infer
    # a filter, push it below that projection and count a second time
    counts = token_counts(tokens("text"), reset)
    return (
        _documents(spark, sf_dir)
        .select("doc_id", F.explode(counts).alias("c"))
        .select("doc_id", "c.token", "c.n")
    )


@query("parse_email")
def parse_email(spark, sf_dir):
    parsed = valid(parse_emails(_email_lines(spark, sf_dir)))
    return parsed.select(
        "ip",
        "port",
        "date_time",
        "fr",
        "to",
        F.md5("subject").alias("subject_md5"),
        F.md5("content").alias("content_md5"),
    )


@query("doc_tokens")
def doc_tokens(spark, sf_dir):
    return (
        _documents(spark, sf_dir)
        .select("doc_id", F.posexplode(tokens("text")).alias("position", "token"))
        .select("doc_id", F.col("position").cast("bigint").alias("position"), "token")
    )


@query("doc_token_total")
def doc_token_total(spark, sf_dir):
    words = _documents(spark, sf_dir).select("doc_id", tokens("text").alias("words"))
    counted = words.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_tokens"),
        token_counts(F.col("words"), reset=True).alias("counts"),
    )
    return counted.select("doc_id", "n_tokens", total_tokens(F.col("counts")).alias("total"))


@query("term_freq")
def term_freq(spark, sf_dir):
    return _count_rows(spark, sf_dir, reset=False)


@query("term_freq_reset")
def term_freq_reset(spark, sf_dir):
    return _count_rows(spark, sf_dir, reset=True)


@query("doc_sentence_tokens")
def doc_sentence_tokens(spark, sf_dir):
    """Tokens by sentences, contractions and quotes."""
    words = F.posexplode(sentence_tokens("text")).alias("position", "token")
    return (
        _spoken(spark, sf_dir)
        .select("doc_id", words)
        .select("doc_id", F.col("position").cast("bigint").alias("position"), "token")
    )


@query("sentence_term_freq")
def sentence_term_freq(spark, sf_dir):
    counts = F.explode(token_counts(sentence_tokens("text"))).alias("c")
    return _spoken(spark, sf_dir).select("doc_id", counts).select("doc_id", "c.token", "c.n")


@query("freq_json")
def freq_json(spark, sf_dir):
    counts = token_counts(tokens("text"))
    return _documents(spark, sf_dir).select("doc_id", counts_json(counts).alias("counts_json"))


# --- lexicon scores


def _scored(spark, sf_dir, lexicon):
    documents = inputs.with_phrase(_documents(spark, sf_dir))
    return score_text(documents, "text", (lexicon,)).select(
        "doc_id", "total", F.col(f"{lexicon.name}_hits").alias("hits")
    )


def _hit_rows(scored):
    """One row per document and class; the hits are in class id order from 0.

    No document lacks hits, so the outer form changes nothing but keeps Catalyst from inferring a
    filter that would score a second time.
    """
    return scored.select("doc_id", "total", F.posexplode_outer("hits").alias("class_id", "hits"))


@query("topic_hits")
def topic_hits(spark, sf_dir):
    return _hit_rows(_scored(spark, sf_dir, TOPIC)).select("doc_id", "class_id", "hits")


@query("topic_hits_joined")
def topic_hits_joined(spark, sf_dir):
    """The same hits by a join with the lexicon as a table, heavy words dealt out apart."""
    words = tokens("text")
    counted = inputs.with_phrase(_documents(spark, sf_dir)).select(
        "doc_id", token_counts(words).alias("counts")
    )
    lexicon = lexicon_table(spark, TOPIC).select("class_id", "word")
    scored = hits_by_join(counted, "doc_id", lexicon, TOPIC.class_ids, broadcast=False)
    return _hit_rows(scored).select("doc_id", "class_id", "hits")


@query("table_lexicon_hits")
def table_lexicon_hits(spark, sf_dir):
    """A lexicon that is itself a table: the benchmark vocabulary, in two classes by length."""
    words = tokens("text")
    vocabulary = (
        table(spark, sf_dir, "benchmark")
        .select(F.explode(words).alias("token"))
        .select(F.lower("token").alias("word"))
        .distinct()
        .select((F.length("word") % 2).alias("class_id"), "word")
    )
    vocabulary = stored(vocabulary, "vocabulary")
    counted = _documents(spark, sf_dir).select("doc_id", token_counts(words).alias("counts"))
    scored = hits_by_join(counted, "doc_id", vocabulary, (0, 1))
    return _hit_rows(scored).select("doc_id", "total", "class_id", "hits")


@query("topic_scores")
def topic_scores(spark, sf_dir):
    return _hit_rows(_scored(spark, sf_dir, TOPIC)).select(
        "doc_id", "class_id", scoring.share(F.col("hits"), F.col("total")).alias("score")
    )


def _labelled(spark, sf_dir, lexicon):
    scored = _scored(spark, sf_dir, lexicon).select(
        "doc_id",
        "total",
        F.array_max("hits").alias("hits"),
        scoring.class_of(F.col("total"), F.col("hits"), lexicon.class_ids).alias(lexicon.name),
    )
    return scored.withColumn("label", scoring.class_label(F.col(lexicon.name), lexicon))


@query("topic_label")
def topic_label(spark, sf_dir):
    return _labelled(spark, sf_dir, TOPIC)


@query("sentiment")
def sentiment(spark, sf_dir):
    return _labelled(spark, sf_dir, SENTIMENT)


@query("power")
def power(spark, sf_dir):
    return _labelled(spark, sf_dir, POWER)


@query("fraud_score")
def fraud_score(spark, sf_dir):
    return _scored(spark, sf_dir, FRAUD).select(
        "doc_id",
        "total",
        F.get("hits", F.lit(0)).alias("hits"),
        scoring.share(F.get("hits", F.lit(0)), F.col("total")).alias("fraud_score"),
    )


@query("email_scores")
def email_scores(spark, sf_dir):
    return score_emails(
        parse_emails(_email_lines(spark, sf_dir, inputs.scored_email_lines)), SAMPLES
    )


def _vocabulary(spark, sf_dir):
    """A lexicon table of tens of thousands of words and more, too many to write into a plan."""
    return stored(inputs.vocabulary(_documents(spark, sf_dir)), "vocabulary")


@query("email_scores_by_table")
def email_scores_by_table(spark, sf_dir):
    """Emails scored by lexicons above the inline bound."""
    lines = _email_lines(spark, sf_dir, inputs.scored_email_lines)
    return score_emails_by_table(parse_emails(lines), _vocabulary(spark, sf_dir))


# --- edges and counts


@query("edges")
def email_edges(spark, sf_dir):
    orders = table(spark, sf_dir, "lineitem").select(*inputs.ORDER_COLUMNS)
    return edges(inputs.order_email_lines(spread(orders)))


@query("message_counts")
def message_count(spark, sf_dir):
    messages = timed_messages(inputs.message_lines(table(spark, sf_dir, "events")))
    return message_counts(messages).select(_time_text("window_start"), "message", "n")


@query("message_balance")
def message_balance(spark, sf_dir):
    """Damaged message lines by what became of them: counted, or rejected with a reason."""
    lines = inputs.damaged_message_lines(table(spark, sf_dir, "events"))
    counted = message_counts(timed_messages(lines)).agg(F.sum("n").alias("n"))
    lost = rejected(parse_messages(lines)).groupBy("reason").agg(F.count("*").alias("n"))
    return counted.select(F.lit("counted").alias("fate"), "n").unionByName(
        lost.select(F.col("reason").alias("fate"), "n")
    )


@query("fourth_char_counts")
def fourth_char_count(spark, sf_dir):
    return fourth_char_counts(inputs.trans_lines(table(spark, sf_dir, "events")))


@query("batch_counts")
def batch_count(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("ts").alias("event_time"))
    return batch_counts(events).select(_time_text("window_start"), "n")


# --- streams: each over three batches with a restart before each


def _events(spark, sf_dir):
    return inputs.by_number(table(spark, sf_dir, "events"), F.col("event_id"))


def _transaction_stream(spark, sf_dir, purpose, encode):
    folder = shared_dir(spark, purpose)
    log = BatchLog(f"{folder}/log")

    def start(events):
        return jobs.start_transactions(
            encode(events),
            log.sink("trans_stream"),
            log.sink("rejected"),
            f"{folder}/checkpoint",
            trigger=jobs.ONCE,
        )

    inputs.fed(spark, folder, _events(spark, sf_dir), start)
    return log


@query("stream_trans")
def stream_trans(spark, sf_dir):
    """Transaction lines, as a stream, into the transaction table."""
    log = _transaction_stream(spark, sf_dir, "stream_trans", inputs.trans_lines)
    return log.sink("trans_stream").read(spark, TRANS_STREAM).select(*TRANS_STREAM.fieldNames())


@query("stream_batch_rows")
def stream_batch_rows(spark, sf_dir):
    """Rows per batch and sink, as counted while they were written and as they are read."""
    log = _transaction_stream(spark, sf_dir, "stream_batch_rows", inputs.damaged_trans_lines)
    kept = [
        log.sink(name).read(spark, schema).select("batch_id", F.lit(name).alias("sink"))
        for name, schema in (("trans_stream", TRANS_STREAM), ("rejected", REJECTED))
    ]
    read = kept[0].unionByName(kept[1]).groupBy("batch_id", "sink").agg(F.count("*").alias("n_read"))
    return log.rows_of(spark).join(read, ["batch_id", "sink"]).select("batch_id", "sink", "n", "n_read")


def _email_stream(spark, sf_dir, purpose, lexicons=SAMPLES):
    folder = shared_dir(spark, purpose)
    log = BatchLog(f"{folder}/log")
    emails, graph = log.sink("email_stream"), log.sink("email_graph")

    def start(documents):
        return jobs.start_emails(
            inputs.scored_email_lines(documents),
            emails,
            graph,
            log.sink("rejected"),
            f"{folder}/checkpoint",
            trigger=jobs.ONCE,
            lexicons=lexicons,
        )

    documents = table(spark, sf_dir, "documents").drop("n_chars")
    inputs.fed(spark, folder, inputs.by_number(documents, F.col("doc_id")), start)
    return emails, graph


@query("stream_email")
def stream_email(spark, sf_dir):
    emails, _ = _email_stream(spark, sf_dir, "stream_email")
    return emails.read(spark, EMAIL_STREAM).select(*EMAIL_STREAM.fieldNames())


@query("stream_email_by_table")
def stream_email_by_table(spark, sf_dir):
    """The stream joined with a lexicon table above the inline bound."""
    words = _vocabulary(spark, sf_dir)
    emails, _ = _email_stream(spark, sf_dir, "stream_email_by_table", words)
    return emails.read(spark, EMAIL_STREAM).select(*EMAIL_STREAM.fieldNames())


@query("stream_email_graph")
def stream_email_graph(spark, sf_dir):
    """The second output of the email stream."""
    _, graph = _email_stream(spark, sf_dir, "stream_email_graph")
    return graph.read(spark, EMAIL_GRAPH).select(*EMAIL_GRAPH.fieldNames())


@query("stream_edges")
def stream_edges(spark, sf_dir):
    """Edges into a sink whose batches are merged into larger files before the last one."""
    folder = shared_dir(spark, "stream_edges")
    log = BatchLog(f"{folder}/log")
    sink = log.sink("email_graph")

    def start(orders):
        sink.compact(spark, EMAIL_GRAPH)
        return jobs.start_edges(
            inputs.order_email_lines(orders),
            sink,
            log.sink("rejected"),
            f"{folder}/checkpoint",
            trigger=jobs.ONCE,
        )

    orders = table(spark, sf_dir, "lineitem").select(*inputs.ORDER_COLUMNS)
    inputs.fed(spark, folder, inputs.by_number(orders, F.col("l_orderkey")), start)
    return sink.read(spark, EMAIL_GRAPH).select(*EMAIL_GRAPH.fieldNames())


@query("stream_message_counts")
def stream_message_count(spark, sf_dir):
    """Counts under Spark's own watermark, which the events reach in order."""
    folder = shared_dir(spark, "stream_message_count")
    sink = FolderSink(f"{folder}/counts")

    def start(events):
        return jobs.start_message_counts(
            inputs.message_lines(events), sink, f"{folder}/checkpoint", trigger=jobs.ONCE
        )

    inputs.fed(spark, folder, inputs.by_time(table(spark, sf_dir, "events"), "ts"), start)
    return latest(sink.read(spark, MESSAGE_COUNTS), "window_start", "message").select(
        _time_text("window_start"), "message", "n"
    )


@query("stream_message_fates")
def stream_message_fates(spark, sf_dir):
    """What became of damaged and late message lines, which add up to the events."""
    folder = shared_dir(spark, "stream_message_fates")
    log = BatchLog(f"{folder}/log")

    def start(events):
        return jobs.start_message_ledger(
            inputs.damaged_message_lines(events), log, f"{folder}/checkpoint", trigger=jobs.ONCE
        )

    inputs.fed(spark, folder, _events(spark, sf_dir), start)
    counted = jobs.ledger_counts(spark, log).agg(F.sum("n").alias("n"))
    lost = log.sink("rejected").read(spark, REJECTED).groupBy("reason").agg(F.count("*").alias("n"))
    return counted.select(F.lit("counted").alias("fate"), "n").unionByName(
        lost.select(F.col("reason").alias("fate"), "n")
    )

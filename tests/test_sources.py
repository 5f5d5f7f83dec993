import pytest
from pyspark.sql import functions as F

from commwatch.functions.lexicons import TOPIC, Lexicon, lexicon_table
from commwatch.session import shared_dir
from commwatch.sources.lines import read_lines, stream_lines
from commwatch.sources.spreading import deal, spread
from commwatch.sources.tables import read_emails, read_lexicon, read_people


def test_people(spark, tmp_path):
    (tmp_path / "people.txt").write_text("a@example.com\nnobody\nb@example.com\n")
    frame = read_people(spark, str(tmp_path / "people.txt"))
    assert {r.address for r in frame.collect()} == {"a@example.com", "b@example.com"}
    frame.write.parquet(str(tmp_path / "people"))
    assert read_people(spark, str(tmp_path / "people"), "parquet").count() == 2


def test_email_corpus(spark, tmp_path):
    path = str(tmp_path / "emails")
    spark.createDataFrame(
        [("a", "b", "c", "d", "not read")],
        "mailfrom string, torecipients string, subject string, content string, more string",
    ).write.parquet(path)
    assert read_emails(spark, path).columns == ["mailfrom", "torecipients", "subject", "content"]


def test_lexicon_file(spark, tmp_path):
    path = str(tmp_path / "lexicon")
    lexicon_table(spark, TOPIC).write.option("header", True).csv(path)
    loaded = Lexicon.from_table(read_lexicon(spark, path), "topic", TOPIC.labels)
    assert set(loaded.words[9]) == set(TOPIC.words[9])


def test_lines(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("a|b\n\nc|d\n")
    assert [r.value for r in read_lines(spark, str(tmp_path / "lines.txt")).collect()] == [
        "a|b", "", "c|d",
    ]


def test_stream_lines(spark, tmp_path):
    lines = stream_lines(spark, "text", path=str(tmp_path), maxFilesPerTrigger=1)
    assert lines.isStreaming and lines.columns == ["value"]
    with pytest.raises(ValueError):
        stream_lines(spark, "csv", path=str(tmp_path))


def test_spread(spark):
    few = spark.range(10, numPartitions=1)
    many = spark.range(100, numPartitions=16)
    assert spread(few) is not few and sorted(r.id for r in spread(few).collect()) == list(range(10))
    assert spread(many) is many


def test_deal_leaves_no_second_wave_of_a_few_tasks(spark):
    cores = spark.sparkContext.defaultParallelism
    dealt = deal(spark.range(0, 100 * cores, numPartitions=cores + 1))
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 * cores and max(r["count"] for r in sizes) <= 2 * 25
    assert sorted(r.id for r in dealt.collect()) == list(range(100 * cores))
    many = spark.range(100, numPartitions=4 * cores)
    assert deal(many) is many
    few = spark.range(10, numPartitions=1)
    assert sorted(r.id for r in deal(few).collect()) == list(range(10))


def test_shared_dir_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(f"{root}/x-") and first != second

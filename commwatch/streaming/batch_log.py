"""A log of committed micro-batches, and sinks whose rows count only once their batch is in it.

A batch writes to all its sinks under the name of this attempt and then adds one record to the log.
Readers take a batch's rows from the attempt that its record names. So a batch that failed between two
sinks shows in neither, and one that is run again replaces its rows in all of them at once.

The log also holds what a batch was: the rows that each sink got and the newest event time.

Folders under the log's path:

    commits/job=/batch_id=/          one record, written last
    merged_commits/<generation>/     records of many batches
    <sink>/loose/job=/batch_id=/attempt=/
    <sink>/merged/<generation>/      rows of many batches, each with its batch and attempt
    <sink>/manifests/<generation>/   the attempts that a generation holds, written after its rows
"""

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

JOB, BATCH, ATTEMPT = "job", "batch_id", "attempt"
KEY = (JOB, BATCH, ATTEMPT)
KEYS = [StructField(JOB, StringType()), StructField(BATCH, LongType()), StructField(ATTEMPT, StringType())]
RECORD = "attempt string, rows map<string,bigint>, newest timestamp_ntz, written timestamp"
COMMITS = f"{RECORD}, job string, batch_id long"
GENERATION = "generation"
MOST_BATCHES = 100_000


def _read(spark, path, schema):
    """A Parquet folder, or no rows where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _delete(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _one_of_each(rows, *order):
    rank = F.row_number().over(Window.partitionBy(JOB, BATCH).orderBy(*order))
    return rows.withColumn("rank", rank).where("rank = 1").drop("rank")


@dataclass(frozen=True)
class BatchLog:
    """The log in a folder that all executors reach."""

    path: str

    def sink(self, name):
        return LoggedSink(self, name)

    def commit(self, spark, job, batch_id, attempt, rows, newest=None):
        """Add the record that makes a batch's rows count, or replace that of an earlier attempt."""
        facts = (attempt, rows, newest, datetime.now(timezone.utc))
        record = spark.createDataFrame([facts], RECORD).coalesce(1)
        folder = f"{self.path}/commits/{JOB}={job}/{BATCH}={int(batch_id)}"
        record.write.mode("overwrite").parquet(folder)

    def batches(self, spark):
        """One record ``(attempt, rows, newest, job, batch_id)`` of each committed batch."""
        loose = _read(spark, f"{self.path}/commits", COMMITS).withColumn("old", F.lit(0))
        merged = _read(spark, f"{self.path}/merged_commits", f"{COMMITS}, generation string")
        # a record of its own is that of a batch run again after its records were merged
        merged = merged.drop(GENERATION).withColumn("old", F.lit(1))
        every = loose.unionByName(merged)
        return _one_of_each(every, "old", F.desc("written"), ATTEMPT).drop("old", "written")

    def newest_before(self, spark, job, batch_id):
        """The newest event time in a job's batches before one, None where there is none."""
        earlier = self.batches(spark).where((F.col(JOB) == job) & (F.col(BATCH) < batch_id))
        return earlier.agg(F.max("newest").alias("newest")).first().newest

    def rows_of(self, spark):
        """Rows that each sink got of each batch: ``job, batch_id, sink, n``."""
        each = F.explode("rows").alias("sink", "n")
        return self.batches(spark).select(JOB, BATCH, each)

    def compact(self, spark):
        """Merge the records of all batches but each job's last, which alone Spark runs again."""
        loose = _read(spark, f"{self.path}/commits", COMMITS)
        last = loose.groupBy(JOB).agg(F.max(BATCH).alias("last"))
        old = loose.join(last, JOB).where(F.col(BATCH) < F.col("last")).drop("last")
        taken = old.limit(MOST_BATCHES).select(ATTEMPT, "rows", "newest", "written", JOB, BATCH)
        folder = f"{self.path}/merged_commits/{GENERATION}={uuid.uuid4().hex}"
        taken.coalesce(1).write.parquet(folder)
        done = spark.read.schema(COMMITS).parquet(folder).select(JOB, BATCH, ATTEMPT).collect()
        for row in done:
            _delete(spark, f"{self.path}/commits/{JOB}={row.job}/{BATCH}={row.batch_id}")
        return len(done)


@dataclass(frozen=True)
class LoggedSink:
    """A Parquet folder of batches that count once their record is in the log."""

    log: BatchLog
    name: str

    @property
    def path(self):
        return f"{self.log.path}/{self.name}"

    def _loose(self, job, batch_id, attempt):
        return f"{self.path}/loose/{JOB}={job}/{BATCH}={int(batch_id)}/{ATTEMPT}={attempt}"

    def write(self, batch, batch_id, job, attempt):
        batch.write.mode("overwrite").parquet(self._loose(job, batch_id, attempt))

    def _manifests(self, spark):
        """The generation that holds each merged attempt; of two that do, one."""
        held = _read(spark, f"{self.path}/manifests", StructType([*KEYS, StructField(GENERATION, StringType())]))
        return held.groupBy(*KEY).agg(F.min(GENERATION).alias(GENERATION))

    def _places(self, spark):
        """The attempt that counts of each batch, and its generation if it is merged."""
        return self.log.batches(spark).select(*KEY).join(self._manifests(spark), list(KEY), "left")

    def read(self, spark, schema):
        """The rows of all committed batches, with ``job`` and ``batch_id``.

        The names of the batches go to the rows: dealt out by batch, all rows of one would meet in
        one task.
        """
        places = self._places(spark)
        full = StructType([*schema.fields, *KEYS])
        loose = _read(spark, f"{self.path}/loose", full)
        merged = _read(
            spark, f"{self.path}/merged", StructType([*full.fields, StructField(GENERATION, StringType())])
        )
        alone = loose.join(F.broadcast(places.where("generation IS NULL")), list(KEY), "left_semi")
        held = merged.join(F.broadcast(places), [*KEY, GENERATION], "left_semi")
        return alone.unionByName(held.drop(GENERATION)).drop(ATTEMPT)

    def compact(self, spark, schema):
        """Merge the rows of all committed batches but each job's last into few files.

        Readers see the same rows before, meanwhile and after: the rows of a batch count from the
        generation as soon as its manifest is there, and a batch that is run again has another
        attempt, which no manifest names. Returns the number of batches merged; ``vacuum`` deletes
        what no longer counts.
        """
        alone = self._places(spark).where("generation IS NULL").drop(GENERATION)
        last = self.log.batches(spark).groupBy(JOB).agg(F.max(BATCH).alias("last"))
        old = alone.join(last, JOB).where(F.col(BATCH) < F.col("last")).select(*KEY)
        taken = old.limit(MOST_BATCHES).collect()  # the names of batches, no rows of theirs
        if not taken:
            return 0
        chosen = spark.createDataFrame(taken, StructType(KEYS))
        generation = uuid.uuid4().hex
        loose = _read(spark, f"{self.path}/loose", StructType([*schema.fields, *KEYS]))
        # rebalancing gives files of the advisory size, however many batches there were
        rows = loose.join(F.broadcast(chosen), list(KEY), "left_semi").hint("rebalance")
        rows.write.parquet(f"{self.path}/merged/{GENERATION}={generation}")
        chosen.coalesce(1).write.parquet(f"{self.path}/manifests/{GENERATION}={generation}")
        return len(taken)

    def vacuum(self, spark):
        """Delete loose rows that have been merged or replaced by another attempt.

        Only batches that are committed or older than their job's last are looked at, so a running
        job loses nothing. Readers that began before a compaction may still read what this deletes:
        run it when they are done.
        """
        present = _read(spark, f"{self.path}/loose", StructType(KEYS)).select(*KEY).distinct()
        counts = self._places(spark).where("generation IS NULL").select(*KEY)
        last = self.log.batches(spark).groupBy(JOB).agg(F.max(BATCH).alias("last"))
        known = present.join(last, JOB).where(F.col(BATCH) <= F.col("last")).drop("last")
        dead = known.join(counts, list(KEY), "left_anti").limit(MOST_BATCHES).collect()
        for row in dead:
            _delete(spark, self._loose(row.job, row.batch_id, row.attempt))
        return len(dead)


def log_of(sinks):
    """The log that sinks share, None for sinks without one; a mixture is an error."""
    logs = {getattr(sink, "log", None) for sink in sinks}
    if len(logs) != 1:
        raise ValueError("the sinks of a job share one log or have none")
    return logs.pop()

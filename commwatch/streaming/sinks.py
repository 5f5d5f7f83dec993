"""Sinks for micro-batches that a replayed batch cannot duplicate."""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from commwatch.schemas import SINK_TABLES

JOB_COLUMN, BATCH_COLUMN = "job", "batch_id"
PARTITIONS = (JOB_COLUMN, BATCH_COLUMN)


def job_of(batch):
    """The identity of the streaming query that calls a batch function.

    Spark keeps it in the checkpoint: a restarted query has the same one, another query or a fresh
    checkpoint has another.
    """
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


@dataclass(frozen=True)
class FolderSink:
    """A Parquet folder with one partition per job and micro-batch.

    A batch overwrites its own partition only, so one that is run again after a failure replaces
    its rows, and batches of equal number of other jobs or checkpoints stay.
    """

    path: str

    def write(self, batch, batch_id, job):
        folder = f"{self.path}/{JOB_COLUMN}={job}/{BATCH_COLUMN}={int(batch_id)}"
        batch.write.mode("overwrite").parquet(folder)

    def read(self, spark, schema):
        """The rows of all batches, with ``job`` and ``batch_id``; an absent folder has none."""
        keys = [StructField(JOB_COLUMN, StringType()), StructField(BATCH_COLUMN, LongType())]
        full = StructType([*schema.fields, *keys])
        try:
            return spark.read.schema(full).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], full)


@dataclass(frozen=True)
class TableSink:
    """A managed table, partitioned by ``job`` and ``batch_id``; see ``reset_tables``."""

    table: str

    def write(self, batch, batch_id, job):
        """Insert by name: the batch may have its columns in any order."""
        spark = batch.sparkSession
        names = [c for c in spark.table(self.table).columns if c not in PARTITIONS]
        if sorted(names) != sorted(batch.columns):
            raise ValueError(f"{self.table} has the columns {names}, the batch {batch.columns}")
        columns = ", ".join(f"`{c}`" for c in names)
        spark.sql(
            f"INSERT OVERWRITE TABLE {self.table} "
            f"PARTITION ({JOB_COLUMN} = '{job}', {BATCH_COLUMN} = {int(batch_id)}) "
            f"SELECT {columns} FROM {{batch}}",
            batch=batch,
        )
        spark.catalog.refreshTable(self.table)  # readers of a replaced partition see the new files

    def read(self, spark, schema=None):
        return spark.table(self.table)


def reset_tables(spark, database="default", tables=tuple(SINK_TABLES)):
    """Drop and create the sink tables. Never called on start-up."""
    for name in tables:
        full_name = f"{database}.{name}"
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in SINK_TABLES[name].fields
        )
        spark.sql(f"DROP TABLE IF EXISTS {full_name}")
        spark.sql(
            f"CREATE TABLE {full_name} ({columns}, {JOB_COLUMN} string, {BATCH_COLUMN} bigint) "
            f"USING parquet PARTITIONED BY ({', '.join(PARTITIONS)})"
        )


def latest(updates, *key):
    """The last emitted value per job and key of an update-mode result kept with its ``batch_id``.

    Batch numbers order the updates of one job only; keys that several jobs emitted come once each.
    """
    values = [c for c in updates.columns if c not in (*key, *PARTITIONS)]
    return (
        updates.groupBy(JOB_COLUMN, *key)
        .agg(F.max_by(F.struct(*values), BATCH_COLUMN).alias("last"))
        .select(*key, "last.*")
    )

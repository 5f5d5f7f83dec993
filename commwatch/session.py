"""Session helpers: a local session for tests and benches, and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus="*", app_name="commwatch", **conf):
    """A local session; on a cluster the submitter supplies the session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark, purpose):
    """A fresh folder name under the folder that ``spark.checkpoint.dir`` names.

    Where the setting is absent, a temporary folder serves a local session. A cluster without the
    setting is an error, because its executors do not share the driver's disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="commwatch-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df, purpose):
    """``df`` written as Parquet under the shared scratch folder and read back.

    For what is costly to derive and read more than once.
    """
    folder = shared_dir(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)

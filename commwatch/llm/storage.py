"""Tables and folders that driver and executors share, and the code that executors need."""

import io
import sys
import zipfile
from functools import partial
from pathlib import Path

from commwatch.session import shared_dir

_SHIPPED = set()


def stored(df, purpose):
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back.

    Cuts the lineage: later reads do not depend on shuffle files of executors that may be lost, and
    what a sampling or ordering decided once stays decided.
    """
    folder = shared_dir(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def store_of(folder):
    """File system and path of a folder's URI, or of a plain path."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(folder)


def write_file(spark, path, data):
    """Some bytes as a file on any file system that Spark itself can write to."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(context._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(data)
    finally:
        out.close()


def ship_package(spark):
    """Give executors this package, once per application, whatever their own Python path holds."""
    package = Path(__file__).resolve().parents[1]
    if spark.sparkContext.applicationId in _SHIPPED or not package.is_dir():
        return
    folder = shared_dir(spark, "code")
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    write_file(spark, f"{folder}/{package.name}.zip", packed.getvalue())
    spark.sparkContext.addPyFile(f"{folder}/{package.name}.zip")
    _SHIPPED.add(spark.sparkContext.applicationId)


def _task(batches, function, encodes):
    """Runs a function of this package; a reused worker keeps its encoders only for tasks that encode."""
    kept = sys.modules.get("commwatch.llm.encoding")
    if kept and not encodes:
        kept.forget()
    yield from function(batches)


def map_arrow(df, function, schema, encodes=False):
    """``df.mapInArrow`` by a function of this package; ``encodes`` if it uses ``encoding.encoder``."""
    ship_package(df.sparkSession)
    return df.mapInArrow(partial(_task, function=function, encodes=encodes), schema)

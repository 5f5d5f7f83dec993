import zipfile

import pyarrow as pa
import pytest

from commwatch.llm import encoding, storage
from commwatch.llm.queries import byte_vocabulary


def test_the_package_reaches_executors_through_any_scheme_of_spark(spark, tmp_path, monkeypatch):
    # Hadoop knows this scheme by its settings, pyarrow does not
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.dbfs.impl", "org.apache.hadoop.fs.viewfs.ViewFileSystemOverloadScheme")
    conf.set("fs.viewfs.mounttable.shared.link./code", f"file:{tmp_path}")
    folder = "dbfs://shared/code"
    with pytest.raises(pa.ArrowInvalid):
        storage.store_of(folder)
    monkeypatch.setattr(storage, "shared_dir", lambda spark, purpose: folder)
    monkeypatch.setattr(storage, "_SHIPPED", set())
    added = []
    monkeypatch.setattr(type(spark.sparkContext), "addPyFile", lambda self, path: added.append(path))
    storage.ship_package(spark)
    storage.ship_package(spark)
    assert added == [f"{folder}/commwatch.zip"]
    assert "commwatch/llm/storage.py" in zipfile.ZipFile(tmp_path / "commwatch.zip").namelist()


def test_a_file_scheme(spark, tmp_path):
    data = bytes(range(256)) * 100
    storage.write_file(spark, f"file:{tmp_path}/some.bin", data)
    assert (tmp_path / "some.bin").read_bytes() == data


def test_a_worker_keeps_encoders_for_tasks_that_encode_only():
    vocabulary = byte_vocabulary()
    encoding.encoder(vocabulary)
    batches = lambda b: b
    assert list(storage._task(iter([1, 2]), batches, True)) == [1, 2] and vocabulary in encoding._ENCODERS
    assert list(storage._task(iter([1, 2]), batches, False)) == [1, 2] and not encoding._ENCODERS

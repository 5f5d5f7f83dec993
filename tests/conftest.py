import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from commwatch.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        "tests",
        **{
            "spark.sql.warehouse.dir": f"{root}/warehouse",
            "spark.checkpoint.dir": f"{root}/shared",
            "spark.sql.catalogImplementation": "in-memory",
            "spark.sql.streaming.stateStore.providerClass": (
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
            ),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip("test tables are absent")
    return SF


@pytest.fixture
def rows(spark):
    """One-column frame of text from a list."""
    return lambda values, name="value": spark.createDataFrame(
        [(v,) for v in values], f"{name} string"
    )

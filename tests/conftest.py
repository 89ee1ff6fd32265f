import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ohlcflow.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "ohlcflow-tests",
        master="local[4]",
        conf={"spark.sql.shuffle.partitions": "8", "spark.default.parallelism": "4"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from ohlcflow.session import scratch_path

    return scratch_path(spark, "test")

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keyfold.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def log(spark):
    """Makes a message log of values, or of (part, pos, value), one second apart."""

    def make(*items):
        rows = []
        for at, item in enumerate(items):
            part, pos, value = item if isinstance(item, tuple) else (0, at, item)
            rows.append(("t", part, pos, 1_700_000_000 + at, value))
        frame = spark.createDataFrame(rows, "topic string, part int, pos bigint, s bigint, value string")
        return frame.selectExpr("topic", "part", "pos", "timestamp_seconds(s) AS ts", "value")

    return make

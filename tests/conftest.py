from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from peopleflow.session import build_session, drop_staged  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "peopleflow-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__log__level="ERROR",
    )
    yield session
    drop_staged(session)
    session.stop()


@pytest.fixture
def log(spark):
    """Build a topic log from (second, topic, value) tuples, offsets in the order given."""

    def build(messages):
        rows = [(topic, 0, i, second, value) for i, (second, topic, value) in enumerate(messages)]
        return spark.createDataFrame(
            rows, "topic string, partition int, offset bigint, second bigint, value string"
        ).selectExpr("topic", "partition", "offset", "timestamp_seconds(second) AS timestamp", "value")

    return build


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()

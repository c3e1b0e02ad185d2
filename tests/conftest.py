from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eddyline.session import build_session  # noqa: E402

EPOCH = dt.datetime(2024, 3, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        spark__driver__memory="4g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(seconds: float) -> dt.datetime:
    """A time ``seconds`` after the tests' origin."""
    return EPOCH + dt.timedelta(seconds=seconds)


def secs(time: dt.datetime | None) -> float | None:
    """Back to seconds after the origin."""
    if time is None:
        return None
    return (time.replace(tzinfo=None) - EPOCH).total_seconds()


def stream_rows(spark, rows, ddl: str):
    """A frame with a TIMESTAMP_NTZ column where ``ddl`` says so."""
    return spark.createDataFrame(rows, ddl)

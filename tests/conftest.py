from __future__ import annotations

import os
import sys
import time
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablestream.session import CHECKPOINT_SETTING, build_session  # noqa: E402

# Times without a zone in the tests mean UTC, wherever they run.
os.environ["TZ"] = os.environ.get("TEST_TZ", "UTC")
time.tzset()

BASE = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    """Seconds after 2024-01-01 00:00:00."""
    return BASE + timedelta(seconds=seconds)


def text_at(seconds: float) -> str:
    return at(seconds).strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        2,
        {"spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get(CHECKPOINT_SETTING, None):
        session.conf.set(CHECKPOINT_SETTING, str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def root(spark, tmp_path):
    return str(tmp_path)


def rows_of(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)

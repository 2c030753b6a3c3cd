import os
import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from ranktrail import schema  # noqa: E402
from ranktrail.ruleset import Ruleset  # noqa: E402
from ranktrail.session import get_spark  # noqa: E402

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests",
        master="local[4]",
        spark__sql__shuffle__partitions=4,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


START = datetime(2024, 1, 10)


def at(minutes: float) -> datetime:
    return START + timedelta(minutes=minutes)


def rules(**changes) -> Ruleset:
    values = dict(
        name="test",
        new_repeat=2,
        hot_repeat=3,
        hot_rank=2,
        tepid_rank=4,
        tepid_age=1140.0,
        cooling_repeat=3,
        cooling_age=3540.0,
        cold_repeat=2,
        cold_age=21600.0,
        failed_repeat=2,
        frozen_age=604800.0,
        frozen_window=0,
    )
    return Ruleset(**{**values, **changes})


@pytest.fixture
def runs(spark):
    def make(*rows):
        """Rows of (ts_run, top, best, new)."""
        full = [(ts, top, best, new, ts, "v", "test") for ts, top, best, new in rows]
        return spark.createDataFrame(full, schema.RUN)

    return make


@pytest.fixture
def records(spark):
    def make(*rows):
        """Rows of (ts_run, story_id, status[, score[, descendants]])."""
        full = [(*r, *[None] * (5 - len(r)), r[0]) for r in rows]
        return spark.createDataFrame(full, schema.RUN_STORY)

    return make


def rows(df, *columns):
    """All rows as a sorted list of tuples."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda t: tuple((v is not None, str(type(v)), v) for v in t))

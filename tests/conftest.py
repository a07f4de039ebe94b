import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barflow.schemas import BARS  # noqa: E402
from barflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "barflow-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def day(text):
    return dt.date.fromisoformat(text)


def bar(sid, when, close=10.0, **changes):
    """A sound bar around ``close``; ``changes`` overrides single columns."""
    row = dict(
        date=day(when) if isinstance(when, str) else when,
        security_id=sid,
        ticker=f"T{sid}",
        open=close,
        high=None if close is None else close + 1,
        low=None if close is None else close - 1,
        close=close,
        adj_close=close,
        volume=100,
    )
    row.update(changes)
    return row


@pytest.fixture
def bars(spark):
    def make(rows):
        return spark.createDataFrame([tuple(r[f.name] for f in BARS.fields) for r in rows], BARS)

    return make


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def days(start, count, step=1):
    first = day(start)
    return [first + dt.timedelta(days=i * step) for i in range(count)]

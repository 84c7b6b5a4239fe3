import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rillhouse.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", memory="8g", app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def at(seconds: float) -> datetime:
    """A time of day on a fixed day, as an instant."""
    return datetime.fromtimestamp(1_700_000_000 + seconds, tz=timezone.utc)


def rows(df, *columns):
    """Sorted tuples of some columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple(map(str, r)))

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("TRACKLOOM_DRIVER_MEMORY", "6g")


@pytest.fixture(scope="session")
def spark():
    from trackloom.session import build_session

    session = build_session("tests", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows_of():
    def collect(df, *columns):
        return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())

    return collect

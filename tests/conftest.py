import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from staylytics.session import get_session, release_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("staylytics-tests", cores=os.environ.get("TEST_CPUS", "8"))
    yield session
    release_scratch(session)


def values(df, *columns):
    """Sorted rows as tuples."""
    cols = columns or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)

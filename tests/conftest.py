import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "tests",
        "4",
        **{"spark.driver.memory": "4g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ledgerline-tests-")},
    )
    yield session
    session.stop()


def as_set(df, *cols):
    return {tuple(r) for r in (df.select(*cols) if cols else df).collect()}


def close(a, b, tolerance=1e-9):
    if a is None or b is None:
        return a is b
    return abs(a - b) <= tolerance * max(1.0, abs(a), abs(b))

import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowstat.session import get_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"
T0 = datetime(2024, 1, 1, 0, 0, 0)


@pytest.fixture(scope="session")
def spark():
    import tempfile
    # tests get a fresh checkpoint root so stream queries with stable names never resume an old run
    s = get_session("local[4]", 8, app="flowstat-tests",
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="flowstat-test-ckpt-")})
    yield s
    s.stop()


def at(seconds: float) -> datetime:
    """A wall-clock time ``seconds`` after T0 (for TIMESTAMP_NTZ rows)."""
    return T0 + timedelta(seconds=seconds)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())

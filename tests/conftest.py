import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import local_session  # noqa: E402
from silverbrook.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return configure(local_session("4"))


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def rows(spark):
    """Collect as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect


def executed_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()

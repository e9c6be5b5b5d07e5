import datetime
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402

T0 = datetime.datetime(2024, 1, 1, 10, 0, 0)


def at(seconds: float) -> datetime.datetime:
    return T0 + datetime.timedelta(seconds=seconds)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests", "4", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))}
    )
    yield session
    session.stop()


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()

import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewatch.session import ROCKSDB_PROVIDER, local_session, shared_dir  # noqa: E402

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", **{"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER})
    shared_dir(session)
    yield session
    session.stop()


def at(sec: float) -> datetime:
    return START + timedelta(seconds=sec)


def iso(sec: int) -> str:
    return at(sec).strftime("%Y-%m-%dT%H:%M:%SZ")

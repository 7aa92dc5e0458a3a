import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockcast.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, shuffle_partitions=8, app="stockcast-tests")
    yield s
    s.stop()


def utc(*args) -> datetime:
    return datetime(*args, tzinfo=timezone.utc)

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidepool.session import build_session
    s = build_session("local[4]", app_name="tidepool-tests", shuffle_partitions=8,
                      conf={"spark.sql.session.timeZone": "UTC"})
    yield s
    s.stop()


@pytest.fixture
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")

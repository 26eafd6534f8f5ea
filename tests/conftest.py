import os
import sys
import time

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["TZ"] = "UTC"
time.tzset()


@pytest.fixture(scope="session")
def spark():
    from wharfline.session import local_session

    session = local_session("8", "wharfline-tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()

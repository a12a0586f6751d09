import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    ckpt = tempfile.mkdtemp(prefix="tidemark-test-ckpt-")
    s = build_session(master="local[4]", app="tidemark-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


def ts(text):
    import datetime as dt
    return dt.datetime.fromisoformat(text)

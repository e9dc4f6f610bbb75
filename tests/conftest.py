import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marginlib.session import build_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="marginlib-tests", shuffle_partitions=4)
    # Tests set their own shared folder only when the environment has none.
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="marginlib-test-"))
    shared_dir(s)
    yield s

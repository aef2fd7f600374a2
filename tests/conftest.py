import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import checkpoint_root, get_session
    s = get_session(master="local[4]", app="tidemark-tests", shuffle_partitions=4,
                    conf={"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # a local scratch folder only when the session names none
    yield s


@pytest.fixture
def scratch(spark):
    from tidemark.session import scratch_path
    return scratch_path(spark, "tests")

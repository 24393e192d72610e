import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from adoptlens.session import build_session

    s = build_session("local[4]", 8, app_name="adoptlens-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from adoptlens.session import scratch_path

    return scratch_path(spark, "test")

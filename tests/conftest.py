import os
import sys

import pytest

_TESTS = os.path.dirname(os.path.abspath(__file__))
_ROOT = os.path.dirname(_TESTS)
sys.path.insert(0, _ROOT)
# Python workers unpickle test-defined stub models by module name.
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (_ROOT, _TESTS, os.environ.get("PYTHONPATH")) if p)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from prefspark.session import local_session

    s = local_session("prefspark-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from prefspark.session import scratch_path

    return lambda name: scratch_path(spark, name)

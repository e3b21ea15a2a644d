import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from staylake.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[*]", app="staylake-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, request):
    from staylake.session import run_dir
    return run_dir(spark, request.node.name.replace("[", "_").replace("]", "_"))

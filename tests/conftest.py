import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadence.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("cadence-tests", master="local[4]", shuffle_partitions=4,
                  extra={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="cadence-test-")

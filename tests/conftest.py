import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from msgloom.session import local_session  # noqa: E402
from msgloom.staging import Staging  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, shuffle_partitions=4, memory="6g")


@pytest.fixture
def staging(spark, tmp_path):
    return Staging(spark, str(tmp_path))

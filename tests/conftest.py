import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesmart.session import checkpoint_root, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=8, app="salesmart-tests")
    checkpoint_root(s)
    yield s


@pytest.fixture
def tmpdir_str(tmp_path):
    return str(tmp_path)

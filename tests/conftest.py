import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from formwork.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="formwork-tests")
    yield s


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerlark.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(8, partitions=8, folder=str(tmp_path_factory.mktemp("work")))


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR

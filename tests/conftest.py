import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from shelfwise import local_session  # noqa: E402
from shelfwise.session import drop_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = local_session(8, "tests", spark__checkpoint__dir=f"file:{scratch}")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    drop_scratch(session)
    session.stop()

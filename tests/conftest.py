from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import local_session

    scratch = str(tmp_path_factory.mktemp("scratch"))
    session = local_session(
        8, "tests", **{"spark.driver.memory": "6g", "spark.checkpoint.dir": scratch}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

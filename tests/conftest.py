import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ["COUNTYPANEL_WAREHOUSE"] = str(tmp_path_factory.mktemp("warehouse"))
    from harness.session import local_session

    session = local_session(4, "4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def panel(spark, sf_dir):
    """The derived panel of the smallest test tables, with its county-year counts stored once."""
    from harness.adapter import TestTables

    return TestTables(spark, sf_dir, written=True)

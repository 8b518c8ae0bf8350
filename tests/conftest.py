import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.ordered import HotKeys
from tidemark.session import build_session

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# Thresholds that leave every key whole, cut the larger ones, and cut every key to shreds.
POLICIES = {"whole": HotKeys(), "some": HotKeys(60, 20), "all": HotKeys(1, 3)}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(params=POLICIES, ids=str)
def hot(request):
    return POLICIES[request.param]


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)

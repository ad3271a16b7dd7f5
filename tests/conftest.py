import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from threadtone.session import build_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    options = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = build_session("tests", "local[4]", 4, options)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_of(df):
    """The physical plan as text; the final one if the query has run."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def testdata():
    return TESTDATA

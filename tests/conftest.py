import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradewind import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    built = session.build("tests", "local[8]", 8, {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g",
        "spark.sql.warehouse.dir": "/tmp/tradewind-tests-warehouse"})
    built.sparkContext.setLogLevel("OFF")
    yield built
    built.stop()


@pytest.fixture
def place(spark):
    """A fresh folder for one test."""
    return session.work_dir(spark, "test")

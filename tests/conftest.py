import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tremorlake.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = builder("tests", **{
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tremorlake-tests-"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tremorlake-tests-"),
    }).master("local[8]").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

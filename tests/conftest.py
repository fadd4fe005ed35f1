import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from voltframe import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session.build("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g", "spark.driver.bindAddress": "127.0.0.1"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def frame(spark):
    from voltframe.sources.inline import rows

    return lambda schema, values: rows(spark, schema, values)

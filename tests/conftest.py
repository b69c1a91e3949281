from __future__ import annotations

import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ark.session import session

    shared = str(tmp_path_factory.mktemp("shared"))
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": shared, "spark.driver.memory": "4g", "spark.sql.warehouse.dir": f"{shared}/warehouse"}
    made = session("local[4]", **conf)
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexforge.session import build_session, ship_package

    s = build_session(
        **{"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "3g",
           "spark.checkpoint.dir": "file://" + str(tmp_path_factory.mktemp("shared")), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    )
    s.sparkContext.setLogLevel("ERROR")
    ship_package(s)
    yield s
    s.stop()

from __future__ import annotations

import os
import sys
import time

import pytest

# Python-side datetimes are naive; pin them to UTC like the session zone.
os.environ["TZ"] = "UTC"
time.tzset()

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from eventide.session import build_session

    own = tmp_path_factory.mktemp("shared")
    extra = {"spark.checkpoint.dir": str(own / "checkpoints"), "spark.sql.warehouse.dir": str(own / "warehouse")}
    s = build_session("local[4]", app_name="eventide-tests", shuffle_partitions=4, extra=extra)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def workdir(tmp_path):
    return str(tmp_path)

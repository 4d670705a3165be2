import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from lakeshore.session import build_session
    s = build_session("local[8]", app="lakeshore-tests", shuffle_partitions=8,
                      **{"spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


SF_ORACLE = os.environ.get("LAKESHORE_ORACLE_SF", "/root/testdata/sf0.01")
SF_SMALL = "/root/testdata/sf0.001"

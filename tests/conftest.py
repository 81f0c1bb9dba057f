import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from martflow.session import build_session
    s = build_session("local[4]", app="martflow-tests", shuffle_partitions=8)
    if not s.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="martflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def wh(spark):
    from martflow.plans.warehouse import Warehouse
    return Warehouse(spark, SF_SMOKE)


@pytest.fixture()
def scratch(spark):
    from martflow.session import scratch_dir
    return lambda purpose="t": scratch_dir(spark, purpose)

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from retentia.session import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="retentia-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_layers(spark):  # layers are stored once per input
    from retentia.plans.layers import Layers
    return Layers.from_testdata(spark, SF_SMALL)

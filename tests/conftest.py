import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from chronoframe.session import get_spark
    s = get_spark("local[4]", 8, extra={"spark.driver.memory": "4g"})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cf-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="cf-test-")

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from curvelake.session import get_spark, shared_dir

    s = get_spark("local[4]", 8)
    if not s.conf.get("spark.checkpoint.dir", None):  # tests only: a local shared folder
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="curvelake-test-"))
    shared_dir(s)
    yield s


@pytest.fixture()
def scratch(spark):
    from curvelake.session import scratch_path

    return scratch_path(spark, "test")

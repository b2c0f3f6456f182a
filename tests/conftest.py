import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from docflow.session import get_session

    # tests run without a cluster: the shared folder is unset, so pick one here
    scratch = tempfile.mkdtemp(prefix="docflow-tests-")
    s = get_session(
        "local[4]",
        app="docflow-tests",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def scratch(spark):
    from docflow.session import shared_dir

    return shared_dir(spark, "test")

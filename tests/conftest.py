import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gasledger.session import checkpoint_root, get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "4g",
        "spark.sql.maxMetadataStringLength": "1000",  # plan tests read pushed filters in full
    }
    session = get_session("local[*]", "gasledger-tests", conf)
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir() and not session.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    ):
        # tests only: the cluster names a shared folder, a local run may not
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/tests/{uuid.uuid4().hex}"

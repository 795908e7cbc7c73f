import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from vaxmart.session import build_session

    session = build_session("local[4]", app_name="vaxmart-tests", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        ckpt = str(tmp_path_factory.mktemp("ckpt"))
        session.conf.set("spark.checkpoint.dir", ckpt)
        session.sparkContext.setCheckpointDir(ckpt)
    yield session
    session.stop()


@pytest.fixture
def workdir(tmp_path):
    return str(tmp_path)

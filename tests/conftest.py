import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from fleetmatch.session import build_session

    session = build_session(
        master="local[8]", shuffle_partitions=8, app="fleetmatch-tests", spark_ui_enabled="false",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()

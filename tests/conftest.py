import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from linkforge.session import session

    s = session("tests", cores=os.environ.get("TEST_CPUS", "4"), partitions=4, memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"

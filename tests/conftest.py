import os
import pathlib
import sys

import pytest

HERE = pathlib.Path(__file__).resolve().parent
sys.path.insert(0, str(HERE.parent))
# Python workers load the senders that the tests define
os.environ["PYTHONPATH"] = os.pathsep.join([str(HERE), os.environ.get("PYTHONPATH", "")])

from tslines.session import local_session, prepare  # noqa: E402

TESTDATA = pathlib.Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tslines-tests", cores="8", partitions=4, memory="6g", conf={"spark.default.parallelism": "2"})
    session.sparkContext.setLogLevel("OFF")
    prepare(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return str(TESTDATA / "sf0.001")

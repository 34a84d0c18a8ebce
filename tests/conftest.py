import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from logloom.session import local_session

    session = local_session(4, "logloom-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def rows(spark):
    """``rows([...], "a string, b int")`` makes a frame."""
    return lambda data, schema: spark.createDataFrame(data, schema)

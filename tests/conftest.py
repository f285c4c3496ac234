import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallyhouse.session import local_session

    session = local_session("tests", memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def run(spark):
    from tallyhouse.queries.registry import run_for

    return run_for(spark, SMALL)


@pytest.fixture(scope="session")
def star(run):
    return run.star


@pytest.fixture
def rows(spark):
    """A DataFrame of literal rows."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make

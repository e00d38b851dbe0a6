import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from partlens.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8)
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data(spark):
    from partlens.plans.relations import Data

    return Data(spark, DATA)


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema as a DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import session  # noqa: E402
from checks.inputs import Inputs  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = session()
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def inputs(spark):
    return Inputs(spark, SF)


@pytest.fixture(scope="session")
def finished(inputs):
    """One whole run over the test data."""
    return inputs.whole_run

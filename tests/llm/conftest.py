import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import fixtures  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    """The awkward documents, in several partitions."""
    return spark.createDataFrame(fixtures.rows(), fixtures.DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], fixtures.DOCS)

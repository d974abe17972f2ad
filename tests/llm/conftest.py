import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest  # noqa: E402
from fixtures import documents, no_documents  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    df, rows = documents(spark)
    return df, rows


@pytest.fixture(scope="session")
def no_docs(spark):
    return no_documents(spark)


def pytest_collection_modifyitems(items):
    """Python workers import the package by path, like the driver."""
    os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], sys.path[1], os.environ.get("PYTHONPATH", "")])

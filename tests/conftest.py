import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tableferry.session import local_session

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("warehouse")
    session = local_session("4", 4, {"spark.sql.warehouse.dir": str(folder)})
    yield session
    session.stop()


@pytest.fixture
def table(request):
    """A table name of the test's own."""
    name = request.node.name.replace("[", "_").replace("]", "").replace("-", "_").lower()[:60]
    return f"{name}_{request.node.path.stem}"


@pytest.fixture(scope="session")
def tiny():
    return f"{TESTDATA}/sf0.001"

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from saldomart.session import local_session  # noqa: E402
from saldomart.sources.tables import Warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "saldomart-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pagequarry.session import Workspace, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests", **{"spark__ui__showConsoleProgress": "false"})
    yield session
    session.stop()


@pytest.fixture
def ws(spark):
    return Workspace(spark, "test")

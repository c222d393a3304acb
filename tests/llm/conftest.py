import pytest

from pagequarry.llm import ranges


@pytest.fixture(autouse=True, scope="session")
def no_waits():
    """Shuffle files of small tables may stay a while."""
    ranges.WAIT = 0

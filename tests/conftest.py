import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from farelens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4, "farelens-tests", "4g")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Result rows as plain dicts."""
    return lambda df: [r.asDict(recursive=True) for r in df.collect()]

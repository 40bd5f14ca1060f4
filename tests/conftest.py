import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from hybridflow.session import build_session, prepare  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=8)
    prepare(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return str(TESTDATA / "sf0.001")

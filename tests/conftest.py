import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from faremill.session import local_session  # noqa: E402
from faremill.settings import Settings  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="faremill-tests", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def january():
    return Settings(date(2025, 1, 1), date(2025, 1, 21), date(2025, 1, 27), date(2025, 1, 31))

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from kliping.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="6g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="kliping-tests-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session

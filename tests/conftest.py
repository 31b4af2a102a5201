import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

DATA = Path(os.environ.get("TEST_DATA", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark():
    from corpuscle.session import local_session

    session = local_session("tests", "4", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not DATA.exists():
        pytest.skip("no test tables")
    return str(DATA)

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ.setdefault("FEEDLOOM_DRIVER_MEMORY", "4g")
DATA = Path(os.environ.get("FEEDLOOM_DATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    from feedloom.session import build_session

    s = build_session("tests", "local[4]", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def small():
    """Directory of the smallest data, or skip."""
    d = DATA / "sf0.001"
    if not d.exists():
        pytest.skip("no test data")
    return str(d)

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from loomline.plans.session import session

    s = session(4, 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    path = "/root/testdata/sf0.001"
    if not Path(path).exists():
        pytest.skip("no test data")
    return path

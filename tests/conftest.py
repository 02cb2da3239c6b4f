from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from oracle import session

    started = session()
    started.conf.set("spark.sql.shuffle.partitions", "2")
    return started

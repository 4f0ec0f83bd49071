from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from fundlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Several shuffle partitions on purpose: operators are checked across partitions.
    s = build_session("fundlens-tests", master="local[4]", shuffle_partitions=4, log_level="ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def seed(spark):
    from seed_data import seed_star

    return seed_star(spark)


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="fundlens-test-")

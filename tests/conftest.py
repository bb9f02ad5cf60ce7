from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from salesmart.session import local_session  # noqa: E402

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "salesmart-tests")


@pytest.fixture(scope="session")
def sf_dir():
    return SMALLEST

from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="ledgerline-warehouse-")
    s = build_session(
        master="local[4]",
        shuffle_partitions=4,
        app_name="ledgerline-tests",
        extra={"spark.sql.warehouse.dir": warehouse},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    # A fresh folder per test; never cleaned by rm (the OS tmp policy does it).
    return tempfile.mkdtemp(prefix="ledgerline-test-")

"""Shared session and comparison helpers."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from larder.session import local_session

    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session("tests", partitions=4, conf={"spark.sql.warehouse.dir": warehouse})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

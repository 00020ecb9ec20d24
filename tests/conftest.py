from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from usagemart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("usagemart-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.default.parallelism": "8",
        "spark.driver.memory": "8g",
        "spark.sql.codegen.cache.maxEntries": "500",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

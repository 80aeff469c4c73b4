from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from candlelake.session import build_session  # noqa: E402


def make_session():
    settings = {
        "spark.master": f"local[{os.environ.get('TEST_CPUS', '8')}]",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="candlelake-test-"),
    }
    spark = build_session("candlelake-tests", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from rolescope.session import get_session
    session = get_session("rolescope-tests", {
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }, master="local[4]")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows(df):
    """Rows as plain tuples, in result order."""
    return [tuple(r) for r in df.collect()]

from __future__ import annotations

import os
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from docflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    os.chdir(root)
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(root / "warehouse"),
        "spark.checkpoint.dir": str(root / "shared"),
    }
    session = build_session("docflow-tests", "local[4]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def load_fixture(spark):
    """Rows of a JSON or CSV file, read by Spark's own readers."""
    readers = {".json": spark.read.option("multiLine", True).json, ".csv": spark.read.option("header", True).csv}
    return lambda path: readers[path.suffix.lower()](str(path))

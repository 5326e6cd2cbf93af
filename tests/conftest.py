"""One local session for all tests, and helpers for hand-made rows."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roadgrain.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "roadgrain-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "1000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def rows(spark):
    """rows(ddl, *tuples) -> DataFrame."""

    def make(ddl: str, *tuples):
        return spark.createDataFrame(list(tuples), ddl)

    return make


def values(data, *columns):
    """Collected rows as plain tuples, in the given column order."""
    picked = data.select(*columns) if columns else data
    return [tuple(row) for row in picked.collect()]

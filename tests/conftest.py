from __future__ import annotations

import contextlib
import io
import os
import sys
import uuid

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    name = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


@pytest.fixture
def plan():
    """The physical plan of a frame, as text."""

    def text(frame, mode: str = "formatted") -> str:
        printed = io.StringIO()
        with contextlib.redirect_stdout(printed):
            frame.explain(mode)
        return printed.getvalue()

    return text


def rows(frame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=repr)

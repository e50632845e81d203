from __future__ import annotations

import contextlib
import io

import pytest

from ridelake.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture
def frame(spark):
    def make(ddl: str, *rows):
        return spark.createDataFrame([row if isinstance(row, tuple) else (row,) for row in rows], ddl)

    return make


def by_text(row):
    return tuple(map(str, row))


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=by_text)


def plan_of(df):
    """The physical plan before execution."""
    text, conf = io.StringIO(), df.sparkSession.conf
    conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        with contextlib.redirect_stdout(text):
            df.select("*").explain("simple")
    finally:
        conf.unset("spark.sql.maxMetadataStringLength")
    return text.getvalue()

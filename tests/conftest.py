from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from smogline.session import local_session, small_table  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("smogline-tests", cpus=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def table(spark):
    """Literal rows as a table: table({"x": "double"}, (1.0,), (None,))."""

    def make(columns: dict[str, str], *rows: tuple):
        return small_table(spark, list(rows), columns)

    return make


@pytest.fixture(scope="session")
def cleaned(spark, folder):
    from smogline.plans.observations import staged_clean

    return staged_clean(spark, folder)


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()

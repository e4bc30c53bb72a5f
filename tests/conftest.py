from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from storeloom import schemas  # noqa: E402
from storeloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="storeloom-test-")
    session = build_session(
        "storeloom-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
            "spark.checkpoint.dir": f"{folder}/scratch",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_options(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_options
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def landing(spark):
    """Landing tables from rows; a table that is not given is empty."""

    def build(**rows):
        return {
            name: spark.createDataFrame(rows.get(name, []), schemas.struct(ddl))
            for name, ddl in schemas.LANDING.items()
        }

    return build


@pytest.fixture
def star(spark):
    """Warehouse tables, wide, from rows, with the totals the marts share."""
    from storeloom.plans import marts

    def build(**rows):
        return marts.with_totals(
            {
                name: spark.createDataFrame(rows.get(name, []), schemas.struct(schemas.wide(ddl)))
                for name, ddl in schemas.WAREHOUSE.items()
            }
        )

    return build


@pytest.fixture
def rows():
    return lambda df: [tuple(row) for row in df.collect()]

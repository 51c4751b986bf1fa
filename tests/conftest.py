from __future__ import annotations

import glob
import os
import sys
import tempfile

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemill.session import build_session  # noqa: E402

SMALL = os.path.join(os.environ.get("TESTDATA", "/root/testdata"), "sf0.001")


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="tidemill-test-")
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"{work}/shared",
            "spark.sql.warehouse.dir": f"{work}/warehouse",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture
def root(spark):
    from tidemill.sources.shared import run_dir

    return run_dir(spark, "test")


@pytest.fixture
def database(spark, root):
    from tidemill.sources.tables import create_database

    name = "db_" + root.rsplit("-", 1)[1]
    create_database(spark, name, root)
    return name

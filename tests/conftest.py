import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quire.session import build_session

    ckpt = tempfile.mkdtemp(prefix="quire-test-ckpt-")
    s = build_session("local[4]", shuffle_partitions=4, app="quire-tests",
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from quire.sources.tables import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="quire-test-")

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from nimbusmart.session import build_session

    scratch = tempfile.mkdtemp(prefix="nimbusmart-tests-")
    session = build_session(
        "nimbusmart-tests",
        master="local[*]",
        shuffle_partitions=8,
        extra_conf={
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from helpers import SF_SMALL

    con = duckdb.connect()
    tables = ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split()
    for t in tables:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con

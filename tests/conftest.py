import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from metroflow.session import local_session, shared_root
    s = local_session(cpus="*", shuffle_partitions=8, app="metroflow-tests")
    shared_root(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from metroflow.sources.tables import TABLE_NAMES, table_path
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con

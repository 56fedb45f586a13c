import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import get_session
    s = get_session("local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for name in ("region nation customer supplier part orders lineitem events").split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMOKE}/{name}.parquet')")
    return con


def rows(df, cols=None):
    """Sorted list of row tuples (Spark DataFrame)."""
    cols = cols or df.columns
    def key(t):
        return tuple((False, 0) if v is None else (True, v) for v in t)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)

from __future__ import annotations

import os
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from tidemill.session import local_session

    session = local_session(4, "4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    """Rows of an SQL text over the tables of a scale factor."""
    import duckdb

    def run(sql: str, sf: str):
        c = duckdb.connect()
        for t in TABLES:
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{sf}/{t}.parquet'")
        return c.sql(sql).to_arrow_table()

    return run


def as_rows(table) -> Counter:
    """Rows as a multiset, columns by name."""
    names = sorted(table.column_names)
    return Counter(tuple(round(r[n], 9) if isinstance(r[n], float) else str(r[n]) for n in names) for r in table.to_pylist())

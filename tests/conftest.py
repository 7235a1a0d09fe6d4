from __future__ import annotations

import math
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from quadrille.session import local_session, ship  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="6g", partitions=4)
    session.sparkContext.setLogLevel("OFF")
    ship(session, str(ROOT / "suite"), str(ROOT / "tests"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()

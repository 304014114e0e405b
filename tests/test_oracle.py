"""Every query equals its SQL twin on the same tables, without Python on rows."""

import duckdb
import pytest
from tests.conftest import SF_DIR, plan_of

from prefshare.catalog.oracle import ORACLE
from prefshare.catalog.queries import QUERIES

TABLES = ("part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(r[i] for i in order) for r in rows), key=repr
    )


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin_can_be_kept_as_a_view(duck, name):
    duck.execute(f"CREATE VIEW twin_{name} AS {ORACLE[name]}")
    assert duck.execute(f"SELECT count(*) FROM twin_{name}").fetchone()[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = by_name(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLE[name])
    want = by_name([c[0] for c in result.description], result.fetchall())
    assert got == want
    assert got[1]
    plan = plan_of(df)
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct"):
        assert node not in plan

"""Every registered query with SQL gives the same rows as that SQL; every other query gives rows."""

import duckdb
import pytest
from helpers import SMALL

import __spark_entry__ as entry_points

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    yield con
    con.close()


def _key(row):
    return tuple((v is None, str(type(v)), 0 if v is None else v) for v in row)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    cols = sorted(frame.columns)
    found = sorted((tuple(r) for r in frame.select(*[f"`{c}`" for c in cols]).collect()), key=_key)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    expected = sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=_key)
    assert found == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    frame = QUERIES[name](spark, SMALL)
    assert frame.columns and frame.count() > 0


def test_flagship(spark):
    found = {r["label"]: r["calls"] for r in entry_points.entry(spark).collect()}
    assert found == {"anomaly": 1160, "normal": 1008, "none": 3734}

"""Every registered query of the engine against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

from docframe.plans import catalog, package_queries, source_queries  # noqa: F401
from docframe.plans.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def value(x):
    return round(x, 9) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(value(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLE_SQL:
        assert columns and got is not None
        return
    found = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted((tuple(value(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
    assert got == want

"""Every reference query against its SQL at the smallest scale."""

import os

import duckdb
import pytest

from statloom import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def shown(v):
    if isinstance(v, float):
        return f"{v:.9g}" if v else "0"
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_equals_sql(name, spark, con):
    df = plans.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(map(shown, r)) for r in df.select(*columns).collect())
    cursor = con.execute(plans.SQL[name])
    names = [c[0] for c in cursor.description]
    at = [names.index(c) for c in columns]
    assert sorted(names) == columns and got == sorted(tuple(shown(r[i]) for i in at) for r in cursor.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and os.path.exists(SF)

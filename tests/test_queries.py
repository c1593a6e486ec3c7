"""Every registered query of the library proper runs, and agrees with its SQL where it has any."""

import duckdb
import pytest

from corpusloom.plans import QUERIES, SQL, Tables


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in Tables.NAMES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def shown(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, duck):
    df = QUERIES[name](Tables(spark, sf))
    cols = sorted(df.columns)
    rows = sorted(tuple(map(shown, r)) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    assert rows
    if name in SQL:
        got = duck.execute(SQL[name])
        names = [d[0] for d in got.description]
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        assert rows == sorted(tuple(shown(r[i]) for i in at) for r in got.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0

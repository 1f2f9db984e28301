"""Every registered query against its DuckDB oracle (driver-style compare) at sf0.001."""

import duckdb
import pytest

from sizes import SF_SMALL
from oracle_check import TABLES, rows_of


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _keys():
    from tessera.plans import registry

    registry.load_all()
    return sorted(registry.QUERIES)


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, con, key):
    from tessera.plans import registry

    df = registry.QUERIES[key](spark, SF_SMALL)
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(registry.ORACLE[key])
    dcols = [d[0] for d in res.description]
    assert sorted(scols) == sorted(dcols)
    assert rows_of(scols, srows) == rows_of(dcols, res.fetchall())


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0

"""Every value-checkable registered query equals its DuckDB twin (sf0.001)."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from matchlake.sources.tables import TABLES
from tools.oracle_check import rows_of

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, sf, con, name):
    sdf = queries()[name](spark, sf)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)


def test_every_query_has_an_id_prefix():
    import re
    from matchlake.plans import catalog
    for name in catalog.QUERIES:
        assert re.match(r"^[a-z]\d\d_", name), name


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "all_rules_pass_rate" in df.columns

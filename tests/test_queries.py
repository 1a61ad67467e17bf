"""Every query with SQL against DuckDB at the smallest scale."""

import os

import duckdb
import numpy as np
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = "events documents embeddings pages benchmark labels conversations".split()


def plain(rows, columns):
    def value(v):
        if v is None or (isinstance(v, float) and np.isnan(v)):
            return ""
        return f"{round(float(v), 5):.5f}" if isinstance(v, (float, np.floating)) else str(v)

    return sorted(tuple(value(v) for v in r) for r in rows[columns].astype(object).itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = __spark_entry__.queries()[name](spark, SF).toPandas(), con.execute(__spark_entry__.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got, sorted(got.columns)) == plain(want, sorted(got.columns))

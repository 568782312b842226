import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from tallywell.plans import driver_queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
def test_queries_match_sql(spark):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    for name, sql in driver_queries.oracle_sql().items():
        got, want = driver_queries.queries()[name](spark, SF).toPandas(), con.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns), name
        plain = lambda v: "" if pd.isna(v) else str(round(float(v), 6)) if isinstance(v, (int, float, np.number)) else str(v)
        key = lambda df: sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False))
        assert key(got) == key(want), name
    assert entry.entry(spark).count() > 0 and set(driver_queries.queries()) <= set(entry.queries())

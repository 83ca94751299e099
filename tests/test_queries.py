"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math

import duckdb
import numpy as np
import pandas as pd
import pytest

from apsis import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def plain(df):
    """Rows as sorted tuples, columns by name, doubles to six digits."""

    def value(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        if isinstance(v, (bool, np.bool_, int, np.integer, float, np.floating)):
            return round(float(v), 6)
        return str(v)

    return sorted((tuple(map(value, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(name, spark, sf, duck):
    got = queries.QUERIES[name](spark, sf).toPandas()
    if name not in queries.SQL:
        assert len(got)
        return
    want = duck.execute(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_entry_and_registry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_ratio_flags_just_below_a_half(spark, tmp_path):
    """64.57 over a mean of 32 is 2.0178125, as a double a little less: the same last digit as SQL gives."""
    duckdb.execute("select event_id, timestamp '2024-01-01' + to_hours(event_id) as ts, 1::bigint as user_id, value from (values (1::bigint, 20.0::double), (2, 11.43), (3, 64.57)) v(event_id, value)").df().to_parquet(tmp_path / "events.parquet")
    got = {r.event_id: r.ratio for r in queries.ratio_flags(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{tmp_path}/events.parquet')")
    assert got == {r[0]: r[1] for r in con.execute(queries.SQL["ratio_flags"]).fetchall()} and got[3] == 2.017812

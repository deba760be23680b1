import os

import pytest

from lexloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF)
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    assert sorted(map(str, map(tuple, got.select(columns).collect()))) == sorted(map(str, want.select(*columns).fetchall()))

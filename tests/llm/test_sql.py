import duckdb

from tilewright.llm import queries

DATA = "/root/testdata/sf0.001"


def test_registered_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{DATA}/documents.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        got, want = queries.QUERIES[name](spark, DATA).toPandas(), con.sql(sql).df()
        columns = sorted(got.columns)
        assert columns == sorted(want.columns)
        assert sorted(map(tuple, got[columns].astype(object).to_numpy())) == sorted(map(tuple, want[columns].astype(object).to_numpy()))

"""Every registered core query equals its SQL on DuckDB, on the smallest tables."""

import duckdb
import pytest

from strandlake.plans import registry

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    return con


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(map(tuple, df.astype(object).where(df.notna(), None).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    assert rows(registry.QUERIES[name](spark, D).toPandas()) == rows(duck.sql(registry.ORACLE_SQL[name]).df())

import duckdb
import pytest

import __spark_entry__ as entry
from beadloom import queries

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(values):
    return tuple("null" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(int(v) if isinstance(v, bool) else v) for v in values)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = queries.queries()[name](spark, SF)
    columns = sorted(got.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = duck.sql(f"SELECT {quoted} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(plain(r) for r in got.select(*columns).collect()) == sorted(map(plain, expected))


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_query_has_rows(spark, name):
    assert queries.queries()[name](spark, "/root/testdata/sf0.001").count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

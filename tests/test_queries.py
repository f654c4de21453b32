import math

import duckdb
import pytest

import __spark_entry__ as entry
from kinforge.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows):
    return sorted(repr(tuple(None if x is None or (isinstance(x, float) and math.isnan(x)) else float(x) if isinstance(x, float) else x for x in r)) for r in rows)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, name):
    frame = entry.queries()[name](spark, SF)
    columns = sorted(frame.columns)
    expected = connect().execute(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({entry.oracle_sql()[name]})")
    assert plain(tuple(r) for r in frame.select(*columns).collect()) == plain(expected.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0

"""Every registered query against its SQL on the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _sorted(rows):
    def plain(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    return sorted((tuple(plain(v) for v in r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = duck.execute(entry_point.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()]
    got, expected = _sorted(df.select(*columns).collect()), _sorted(expected)
    assert len(got) == len(expected) > 0
    for a, b in zip(got, expected):
        assert a == tuple(type(x)(y) if x is not None and y is not None and not isinstance(x, (str, bool)) else y
                          for x, y in zip(a, b))


@pytest.mark.parametrize("name", sorted(set(entry_point.queries()) - set(entry_point.oracle_sql())))
def test_query_without_sql_returns_rows(spark, name):
    assert entry_point.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert entry_point.entry(spark).columns == ["entity", "seg", "score", "flag"]

"""Each query of the catalogue against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from quernflow.plans import archive_catalog, catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables here")


def norm(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(map(norm, value))
    return value


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    cursor = duck.execute(catalog.ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    want = sorted((tuple(norm(dict(zip(columns, r, strict=True))[c]) for c in order) for r in cursor.fetchall()), key=repr)
    got = sorted((tuple(norm(r[c]) for c in order) for r in df.collect()), key=repr)
    assert got == want


def test_each_archive_rule_is_broken_somewhere(duck):
    """On tables of sf0.01, by the SQL alone; the query equals it."""
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{DATA.replace('sf0.001', 'sf0.01')}/{t}.parquet')")
    broken = {r[0] for r in con.execute(catalog.ORACLE["archive_violations"]).fetchall()}
    assert broken == {r.rule for r in archive_catalog.A.rules()}


def test_queries_without_sql_give_rows(spark):
    assert catalog.prompt_ladder(spark, DATA).count() == 200


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

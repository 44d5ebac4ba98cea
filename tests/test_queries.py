"""Every registered query of the core against its SQL, on the smallest tables."""

import os
import re

import duckdb
import pytest

from docloom.plans.queries import registered

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registered()
TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, (bool, str)):
        return str(v)
    return round(float(v), 6) if hasattr(v, "__float__") else str(v)


def rows(records, columns):
    order = sorted(columns)
    return sorted(repr([plain(r[c]) for c in order]) for r in records)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    want = [dict(zip(names, r, strict=True)) for r in cursor.fetchall()]
    assert sorted(names) == sorted(df.columns)
    assert rows([r.asDict() for r in df.collect()], names) == rows(want, names)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_every_query_reads_the_given_tables(spark):
    for name in ("metadata_by_type", "win8_global_ids", "grf2_descendants"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert re.search(r"parquet", plan, re.I)
    assert os.path.isdir(SF)

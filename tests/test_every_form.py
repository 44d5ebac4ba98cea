"""Old ids with several new ones: a row for each, as the SQL's join has it."""

from itertools import product

import duckdb
import pytest

from docloom.operators import rewrite
from docloom.plans.queries import registered
from tests.test_queries import rows

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registered()


@pytest.fixture(scope="module")
def repeated_codes(tmp_path_factory):
    """200 codes of eleven rows each: keys of five digits, and ten of six that are cut to them."""
    at = str(tmp_path_factory.mktemp("repeated-codes"))
    con = duckdb.connect()
    con.execute(f"""copy (select k as p_partkey, p.* exclude (p_partkey) from (select unnest(range(10000, 10200) || range(100000, 102000)) as k) join read_parquet('{SF}/part.parquet') p on p.p_partkey = k % 199 order by k)
        to '{at}/part.parquet' (format parquet)""")
    con.execute(f"create view part as select * from read_parquet('{at}/part.parquet')")
    return at, con


NAMES = ["job_sync_records", "job_sync_report", "job_sync_inside_words", "job_sync_inside_words_report"]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql_where_codes_repeat(spark, repeated_codes, name):
    at, con = repeated_codes
    cursor = con.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    want = [dict(zip(names, r, strict=True)) for r in cursor.fetchall()]
    assert want and rows([r.asDict() for r in QUERIES[name](spark, at).collect()], names) == rows(want, names)


@pytest.mark.parametrize("map_bytes", [rewrite.MAP_BYTES, 0])
def test_every_combination_of_new_ids(spark, map_bytes):
    texts = {1: ("a1 b2 a1", "b2!"), 2: ("a1", None), 3: ("none", ""), 4: (None, "xa12y"), 5: ("c", "b2b2")}
    forms = {"a1": ["p", "q", "q"], "a12": ["long"], "b2": ["r", "s"], "c": ["a1"]}
    records = spark.createDataFrame([(k, *v) for k, v in texts.items()], "k long, a string, b string")
    ids = spark.createDataFrame([(o, n) for o, ns in forms.items() for n in ns] + [(None, "z"), ("", "z"), ("none", None)], "old string, new string")
    found = rewrite.rewrite_every_form(records, ids, ["a", "b"], "k", map_bytes)
    want = []
    for k, named in ((1, ["a1", "b2"]), (2, ["a1"]), (3, []), (4, ["a12"]), (5, ["c", "b2"])):
        for news in product(*(forms[o] for o in named)):
            told = []
            for t in texts[k]:
                for i, o in enumerate(named):
                    t = t and t.replace(o, f"<{i}>")
                for i, n in enumerate(news):
                    t = t and t.replace(f"<{i}>", n)
                told.append(t)
            want.append((k, *told))
    assert sorted(map(repr, want)) == sorted(repr((r.k, r.new_a, r.new_b)) for r in found.collect())

"""Keys beyond the digits that the views show: codes of five digits and guids of six repeat, cards don't."""

import os

import duckdb
import pytest

from docloom.plans import jobs
from docloom.plans.queries import registered
from tests.test_queries import rows

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registered()


@pytest.fixture(scope="module")
def long_keys(tmp_path_factory):
    """Four runs of 1,600 keys of up to seven digits; cards from 100,000 on have one name and brand."""
    at = str(tmp_path_factory.mktemp("long-keys"))
    con = duckdb.connect()
    keys = "(select a + b as k from (values (0), (10000), (100000), (1000000)) t(a), range(1600) r(b))"
    con.execute(f"""copy (select k as p_partkey, p.* exclude (p_partkey) from {keys} join read_parquet('{SF}/part.parquet') p on p.p_partkey = case when k < 100000 then k % 200 else 1 end order by k)
        to '{at}/part.parquet' (format parquet)""")
    con.execute(f"copy (select l.* replace (k // 8 as l_orderkey, k as l_partkey, cast(k % 8 as int) as l_linenumber) from {keys}, (select * from read_parquet('{SF}/lineitem.parquet') limit 1) l) to '{at}/lineitem.parquet' (format parquet)")
    for t in ("part", "lineitem"):
        con.execute(f"create view {t} as select * from read_parquet('{os.path.join(at, t)}.parquet')")
    return at, con


@pytest.mark.parametrize(
    "name",
    ["grf1_components", "grf1_group_lists", "job_attach_by_id", "job_attach_by_id_unused", "join9_template_updates", "snk3_delete_manifest", "snk3_survivors", "job_localize_containers"],
)
def test_query_equals_sql_on_long_keys(spark, long_keys, name):
    at, con = long_keys
    df = QUERIES[name](spark, at)
    cursor = con.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    want = [dict(zip(names, r, strict=True)) for r in cursor.fetchall()]
    assert want and rows([r.asDict() for r in df.collect()], names) == rows(want, names)


def test_numbers_of_any_length_match(spark, long_keys):
    found = [r.obj_id for r in QUERIES["join7_by_number"](spark, long_keys[0]).collect()]
    assert sorted(found) == [a + b for a in (0, 10000, 100000, 1000000) for b in range(1100)]


def test_siblings_of_a_repeated_code_come_once(spark, long_keys):
    found = {r.id: r.siblings.split(",") for r in QUERIES["grf1_reprint_groups"](spark, long_keys[0]).collect() if r.siblings}
    assert all(len(x) == len(set(x)) for x in found.values()) and "10001" in found["10000"]


def test_records_of_one_code_are_synced_apart(spark):
    objects = spark.createDataFrame([("a", "n1", None, "f1", "b1", 1), ("b", "n2", None, "f2", "b2", 2)], "nickname string, id string, zoop_guid string, face_url string, back_url string, ord long")
    records = spark.createDataFrame(
        [("7", "a", 0, "x", "x", "has 9", "l"), ("7", "b", 0, "x", "x", "none", "l"), ("9", "a", 0, "x", "x", "none", "l")],
        "code string, name string, xp long, image_url string, back_image_url string, deck_requirements string, back_link string",
    )
    out, report = jobs.sync_records(objects, records, ("deck_requirements", "back_link"))
    assert sorted((r.code, r.name, r.image_url, r.deck_requirements) for r in out.collect()) == [("n1", "a", "f1", "has n1"), ("n1", "a", "f1", "none"), ("n2", "b", "f2", "none")]
    assert {r.field: r.updates for r in report.collect()} == {"deck_requirements": 1, "back_link": 0, "ids": 3}


def test_numbers_beyond_five_digits_equal_the_sql(spark, tmp_path):
    con = duckdb.connect()
    con.execute(f"""copy (select k as p_partkey, p.* exclude (p_partkey) from range(100100) r(k) join read_parquet('{SF}/part.parquet') p on p.p_partkey = k % 200) to '{tmp_path}/part.parquet' (format parquet)""")
    con.execute(f"create view part as select * from read_parquet('{tmp_path}/part.parquet')")
    want = sorted(con.execute(SQL["join7_by_number"]).fetchall())
    assert len(want) == 99600 and sorted((r.obj_id, r.id) for r in QUERIES["join7_by_number"](spark, str(tmp_path)).collect()) == want

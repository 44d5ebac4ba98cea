"""Queries whose files and names repeat where guids of six digits do: each card's are its own, as in the SQL."""

import pytest

from tests.test_long_keys import QUERIES, SQL, long_keys  # noqa: F401
from tests.test_queries import rows

NAMES = ["doc25_replace_positional", "doc27_bump_ids", "doc17_embed_short_metadata", "join16_files_by_name", "join1_inline_first", "join1_sidecar_first", "join1_path_lookup", "join1_named_sidecar"]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql_where_guids_repeat(spark, long_keys, name):  # noqa: F811
    at, con = long_keys
    cursor = con.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    want = [dict(zip(names, r, strict=True)) for r in cursor.fetchall()]
    assert want and rows([r.asDict() for r in QUERIES[name](spark, at).collect()], names) == rows(want, names)

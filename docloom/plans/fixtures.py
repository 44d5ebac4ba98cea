"""Views of the test tables in the shape of the corpus, for Spark and, as text, for the SQL oracle.

Each view is one list of expressions that both engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.partitions import tasks_for

_GUID = "lpad(cast(p_partkey as string), 6, '0')"
_ID = "lpad(cast(p_partkey % 1500 as string), 5, '0')"
_TYPE = "case p_partkey % 5 when 0 then 'Asset' when 1 then 'Location' when 2 then 'Act' when 3 then 'Investigator' else 'Agenda' end"
_NOTES = f"""'{{"id": "' || {_ID} || '", "type": "' || {_TYPE} || '", "level": ' || cast(p_size % 6 as string)"""

VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "cards": (
        "part",
        {
            "obj_id": "p_partkey",
            "guid": _GUID,
            "path": f"replace(p_brand, '#', '') || '/' || replace(p_name, ' ', '') || '.' || {_GUID} || '.json'",
            "name": "case p_partkey % 10 when 7 then 'CardCustom' when 8 then 'Custom_Tile' when 9 then 'Deck' else 'Card' end",
            "nickname": "p_name",
            "description": "case when p_partkey % 7 = 0 then '' else p_type end",
            "deck_key": "cast(100 + p_size as string)",
            "card_id": "cast(case when p_partkey % 13 = 0 then p_partkey % 10 else (100 + p_size) * 100 + p_partkey % 100 end as bigint)",
            "face_url": "'https://img.example/f/' || cast(p_partkey % 500 as string)",
            "back_url": "case p_partkey % 3 when 0 then 'https://img.example/b/player' when 1 then 'https://img.example/b/scenario' "
            "else 'https://img.example/b/' || cast(p_partkey % 40 as string) end",
            "gm_notes": f"case p_partkey % 11 when 0 then null when 1 then {_NOTES} || ',}}' when 2 then 'Asset' else {_NOTES} || '}}' end",
        },
    ),
    "catalog": (
        "part",
        {
            "code": "lpad(cast(p_partkey as string), 5, '0')",
            "name": "p_name",
            "subname": "case when p_partkey % 7 = 0 then null else p_type end",
            "xp": "cast(p_size % 6 as bigint)",
            "type_code": "case p_partkey % 5 when 1 then 'location' when 4 then 'key' else 'asset' end",
            "double_sided": "p_partkey % 2 = 0",
            "clues": "cast(p_partkey % 4 as bigint)",
            "clues_fixed": "case when p_partkey % 3 = 0 then true end",
            "duplicate_of_code": "lpad(cast(case when p_partkey % 16 = 0 then p_partkey else p_partkey - 1 end as string), 5, '0')",
        },
    ),
    "members": (
        "lineitem",
        {
            "container_id": "l_orderkey",
            "obj_id": "l_partkey",
            "pos": "cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as bigint)",
        },
    ),
    "messages": (
        "events",
        {
            "ts": "ts",
            "message_id": "case event_type when 'view' then 0 when 'click' then 1 when 'signup' then 2 when 'error' then 3 else 5 end",
            "target": "user_id",
            "body": "props",
            "event_id": "event_id",
        },
    ),
    "files": ("documents", {"path": "source || '/' || lang || '/' || cast(doc_id as string) || '.txt'", "content": "text", "doc_id": "doc_id"}),
    "boxes": (
        "(select distinct l_orderkey % 3000 as image_id, l_partkey % 6 as k, l_linenumber as line from lineitem) b",
        {
            "image_id": "image_id",
            "x_px": "cast(70 + k * 22 as double)",
            "z_px": "cast(100 + line * 60 + k as double)",
            "w_px": "cast(18 + image_id % 28 as double)",
            "h_px": "cast(18 + image_id % 28 + k % 3 * 2 as double)",
            "img_w": "cast(750 as double)",
            "img_h": "cast(1050 as double)",
            "solidity": "cast(case when k = 5 then 0.6 else 0.9 end as double)",
            "corners": "4 + line",
        },
    ),
}


def _text(name: str) -> str:
    source, columns = VIEWS[name]
    return f"select {', '.join(f'{e} as {a}' for a, e in columns.items())} from {source}"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as a DataFrame over the parquet tables."""
    text = _text(name)
    if name == "members":  # numbered in tasks of a bounded size, if there are more rows than the session's shuffle partitions are for
        tasks = tasks_for(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
        if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
            columns = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice"
            text = text.replace("from lineitem", f"from (select /*+ repartition({tasks}, l_orderkey) */ {columns} from lineitem)")
    for table in ("part", "lineitem", "events", "documents"):
        text = text.replace(f"from {table}", f"from parquet.`{sf_dir}/{table}.parquet`")
    return spark.sql(text)


def cte(*names: str) -> str:
    """The views as the head of an SQL statement."""
    return "with " + ", ".join(f"{n} as ({_text(n)})" for n in names)

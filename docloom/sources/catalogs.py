"""Catalogues and lookup documents as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import json


def read_catalog(snapshots: DataFrame, text: str = "content", record: str = "code string, name string", at: tuple[str, str] = ("data", "all_card")) -> DataFrame:
    """SRC-6: one row per record of each snapshot {at0: {at1: [...]}}; a snapshot without gives none."""
    outer, inner = at
    parsed = F.from_json(F.col(text), f"{outer} struct<{inner}: array<struct<{_colons(record)}>>>")
    return snapshots.select(F.explode(parsed[outer][inner]).alias("r")).select("r.*")


def _colons(record: str) -> str:
    return ", ".join(f"{c.split()[0]}: {' '.join(c.split()[1:])}" for c in record.split(", "))


def read_mapping_sheet(sheet: DataFrame, row: str = "row") -> tuple[DataFrame, DataFrame]:
    """SRC-7: rows (row, id, name, description, type, metadata) to (mapping, rejects).

    Texts are trimmed, a null description is empty, trailing commas in metadata are repaired. Rows whose metadata isn't
    JSON go to rejects with the sheet's row number (0-based row + 2). Of equal (name, description) the last row wins.
    """
    clean = sheet.select(
        F.col(row).alias("row"), *(F.trim(c).alias(c) for c in ("id", "name", "type")), F.coalesce(F.trim("description"), F.lit("")).alias("description"),
        json.without_trailing_commas(F.col("metadata")).alias("metadata"),
    )
    valid = F.coalesce(json.is_json(F.col("metadata")), F.lit(False))
    kept = clean.where(valid).groupBy("name", "description").agg(F.max_by(F.struct("id", "type", "metadata", "row"), "row").alias("r"))
    return kept.select("name", "description", "r.*"), clean.where(~valid).select((F.col("row") + 2).alias("sheet_row"), "id")


def read_helper_map(docs: DataFrame, text: str = "content") -> tuple[DataFrame, DataFrame]:
    """SRC-8: {name: {type, value, clueSide, tokenType, tokenCount}} to (typed rows, rejects).

    With clueSide a location: type perPlayer gives count_per_investigator, fixed gives count, others are rejected;
    side front or back. Without, an asset that uses tokens, the token's name capitalised.
    """
    info = "map<string, struct<type: string, value: int, clueSide: string, tokenType: string, tokenCount: int>>"
    rows = docs.select(F.explode(F.from_json(F.col(text), info)).alias("name", "i")).select("name", "i.*")
    place = F.col("clueSide").isNotNull()
    ok = ~place | F.col("type").isin("perPlayer", "fixed")
    typed = rows.where(ok).select(
        "name", F.when(place, "Location").otherwise("Asset").alias("type"), F.when(place, F.when(F.col("clueSide") == "front", "front").otherwise("back")).alias("side"),
        F.when(place & (F.col("type") == "fixed"), F.col("value")).alias("count"),
        F.when(place & (F.col("type") == "perPlayer"), F.col("value")).alias("count_per_investigator"),
        F.when(~place, F.concat(F.upper(F.left("tokenType", F.lit(1))), F.lower(F.substring("tokenType", 2, 1_000_000)))).alias("token"),
        F.when(~place, F.col("tokenCount")).alias("tokens"),
    )
    return typed, rows.where(~ok).select("name", "type")


def read_bonded(docs: DataFrame, text: str = "content", order: str = "pos") -> DataFrame:
    """SRC-9: [{code, bound: [{count, id}]}] to (code, bound); the last of equal codes wins, by (order, place in list)."""
    rows = F.from_json(F.col(text), "array<struct<code: string, bound: array<struct<count: int, id: string>>>>")
    found = docs.select(F.col(order).alias("o"), F.posexplode(rows).alias("p", "r"))
    return found.groupBy("r.code").agg(F.max_by("r.bound", F.struct("o", "p")).alias("bound"))

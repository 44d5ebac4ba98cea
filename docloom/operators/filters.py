"""Filters and validation. Narrow unless a docstring says otherwise."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import json, paths


def all_of(column: str, needles: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.contains(F.col(column), F.lit(n)) for n in needles), F.lit(True))


def any_of(column: str, needles: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(F.col(column), F.lit(n)) for n in needles), F.lit(False))


def search_files(files: DataFrame, include_all: Sequence[str] = (), exclude_any: Sequence[str] = (), text: str = "content") -> DataFrame:
    """FLT-1: files that hold every string of the first list and none of the second, literally, by case."""
    return files.where(all_of(text, include_all) & ~any_of(text, exclude_any))


def copy_matching(files: DataFrame, needle: str, target: DataFrame | None = None) -> DataFrame:
    """FLT-2: (name, path) of matching files by bare name; the first path of a name wins, names in `target` are skipped.
    Shuffles by name."""
    hit = search_files(files, [needle]).select(paths.name(F.col("path")).alias("name"), "path").groupBy("name").agg(F.min("path").alias("path"))
    return hit.join(target.select("name").distinct(), "name", "left_anti") if target is not None else hit


def matching_to_delete(files: DataFrame, needle: str, exclude_subtree: str | None = None) -> DataFrame:
    """FLT-3: paths of the files to delete: they hold the needle and lie outside the subtree (by whole components)."""
    hit = search_files(files, [needle])
    return (hit.where(~paths.inside(F.col("path"), exclude_subtree)) if exclude_subtree else hit).select("path")


def named_to_delete(files: DataFrame, needle: str, folder: str | None = None) -> DataFrame:
    """FLT-4: paths whose lower-cased file name holds the needle, in one folder (not below it)."""
    hit = files.where(F.contains(F.lower(paths.name(F.col("path"))), F.lit(needle)))
    return (hit.where(paths.directory(F.col("path")) == folder) if folder is not None else hit).select("path")


def is_card(name: Column, custom: bool = True) -> Column:
    """FLT-5."""
    return name.isin(*(("Card", "CardCustom") if custom else ("Card",)))


def is_object_folder(name: Column) -> Column:
    """FLT-6: two parts that aren't empty around one dot, no blanks."""
    return name.rlike(r"^[^. ]+\.[^. ]+$")


def act_or_agenda_decks(containers: DataFrame, members: DataFrame, key: str, nickname: str, member_type: str) -> DataFrame:
    """FLT-7: containers named like an act or agenda deck, or with a member of such a type. Shuffles by container."""
    typed = members.where(F.col(member_type).isin("Act", "Agenda")).select(F.col(key).alias("__k")).distinct()
    low = F.lower(nickname)
    named = F.contains(low, F.lit("act deck")) | F.contains(low, F.lit("agenda deck"))
    found = containers.join(typed, F.col(key) == F.col("__k"), "left")
    return found.where(F.coalesce(named, F.lit(False)) | F.col("__k").isNotNull()).drop("__k")


def metadata_is_valid(notes: Column) -> Column:
    """FLT-8: missing and empty metadata is valid, other must be JSON."""
    return F.coalesce(notes == "", F.lit(True)) | F.coalesce(json.is_json(notes), F.lit(False))


def validate_metadata(objects: DataFrame, notes: str) -> DataFrame:
    """FLT-8: one row with the numbers scanned and invalid."""
    return objects.agg(F.count(F.lit(1)).alias("scanned"), F.count_if(~metadata_is_valid(F.col(notes))).alias("invalid"))


def validate_documents(files: DataFrame, text: str = "content") -> DataFrame:
    """FLT-9: files with `valid`, whether the text is JSON."""
    return files.withColumn("valid", F.coalesce(json.is_json(F.col(text)), F.lit(False)))


def project_fields(records: DataFrame, fields: Sequence[str]) -> DataFrame:
    """FLT-10: these columns, null where the table has none of that name."""
    return records.select(*(F.col(f) if f in records.columns else F.lit(None).cast("string").alias(f) for f in fields))


def needs_processing(notes: Column, key: str = "id") -> Column:
    """FLT-11: not yet processed: the metadata isn't JSON with that key (of any value)."""
    return ~json.has_key(notes, key)


def parse_where_contains(files: DataFrame, needle: str, text: str = "content") -> DataFrame:
    """FLT-12: parse only texts that hold the needle; the cheap test stands below the parse in the plan."""
    return files.where(F.contains(F.col(text), F.lit(needle))).withColumn("fields", json.as_map(F.col(text)))


def first_seen(df: DataFrame, key: Sequence[str], order: Sequence[str], keep_empty: bool = True) -> DataFrame:
    """WIN-1: the first row of each key in the given order; rows whose first key is null or empty are all kept.
    Shuffles by key, with few rows each."""
    empty = F.col(key[0]).isNull() | (F.col(key[0]).cast("string") == "")
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    kept = df.withColumn("__rank", rank).where((F.col("__rank") == 1) | (empty if keep_empty else F.lit(False)))
    return kept.drop("__rank")

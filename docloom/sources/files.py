"""File corpora as tables: files(path, content), objects, rejects. All narrow, nothing shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import json, paths


def scan_files(
    spark: SparkSession, root: str, suffixes: Sequence[str] = (), exclude_dirs: Sequence[str] = (), recursive: bool = True, exclude_subtree: str | None = None
) -> DataFrame:
    """SRC-1: (path, content) of the text files below `root`, paths relative to it."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if len(suffixes) == 1:
        reader = reader.option("pathGlobFilter", f"*{suffixes[0]}")
    found = reader.text(root, wholetext=True).select(F.col("_metadata.file_path").alias("full"), F.col("value").alias("content"))
    base = root.split("://")[-1].rstrip("/") + "/"
    path = F.substring(F.col("full"), F.instr("full", base) + len(base), F.length("full"))
    return select_files(found.select(path.alias("path"), "content"), suffixes, exclude_dirs, exclude_subtree)


def select_files(files: DataFrame, suffixes: Sequence[str] = (), exclude_dirs: Sequence[str] = (), exclude_subtree: str | None = None) -> DataFrame:
    """The rules of SRC-1 on a table: suffix (case-sensitive), folders pruned at any depth, one subtree left out."""
    kept = files
    if suffixes:
        kept = kept.where(" or ".join(f"endswith(path, '{s}')" for s in suffixes))
    if exclude_dirs:
        kept = kept.where(~F.arrays_overlap(F.split(paths.directory(F.col("path")), "/"), F.array(*map(F.lit, exclude_dirs))))
    return kept.where(~paths.inside(F.col("path"), exclude_subtree)) if exclude_subtree else kept


def decode_text(files: DataFrame, source: str = "content", bom: bool = True, errors: str = "replace") -> DataFrame:
    """SRC-2: bytes to text (UTF-8), a leading byte order mark cut off; with errors="ignore" undecodable bytes go."""
    text = F.make_valid_utf8(F.col(source).cast("string")) if files.schema[source].dataType.simpleString() == "binary" else F.col(source)
    text = F.regexp_replace(text, "^﻿", "") if bom else text
    return files.withColumn("content", F.translate(text, "�", "") if errors == "ignore" else text)


def extract_json_body(files: DataFrame) -> DataFrame:
    """SRC-3: content cut to what lies from the first { to the last }; files without are left out."""
    return files.withColumn("content", json.body(F.col("content"))).where("content is not null")


def parse_objects(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC-4: (files with `fields`, a map of the object's keys; rejects with path and reason). Never fails."""
    valid = F.coalesce(json.is_json(F.col("content")), F.lit(False))
    told = files.withColumn("fields", json.as_map(F.col("content"))).withColumn("valid", valid)
    reason = F.when(F.col("content").isNull(), "no text").when(~F.col("valid"), "not JSON").otherwise("not an object")
    return told.where("fields is not null").drop("valid"), told.where("fields is null").select("path", reason.alias("reason"))


def listing_map(files: DataFrame, extensions: Sequence[str], any_case: bool = True) -> DataFrame:
    """SRC-11: (stem, path) of the files with one of the extensions; reads no content."""
    own = paths.suffix(F.col("path"))
    return files.where((F.lower(own) if any_case else own).isin(*extensions)).select(paths.stem(F.col("path")).alias("stem"), "path")


def extract_pairs(files: DataFrame, pattern: str, source: str = "content") -> DataFrame:
    """SRC-10: (path, pos, name, value) of every match of a two-group pattern, dots matching line feeds."""
    r = f"(?s){pattern}"
    both = F.arrays_zip(F.regexp_extract_all(source, F.lit(r), 1).alias("name"), F.regexp_extract_all(source, F.lit(r), 2).alias("value"))
    return files.select("path", F.posexplode(both).alias("pos", "m")).select("path", "pos", "m.name", "m.value")

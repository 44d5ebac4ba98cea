"""Expressions over paths of the form dir/sub/stem.ext."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def directory(path: Column) -> Column:
    """Everything before the last slash, empty if there is none."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def stem(path: Column) -> Column:
    return F.regexp_replace(name(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    """With its dot, empty if there is none."""
    return F.regexp_extract(name(path), r"(?<=.)(\.[^.]*)$", 1)


def inside(path: Column, folder: str) -> Column:
    """By whole components: a/bc is not inside a/b."""
    return (path == folder) | path.startswith(folder.rstrip("/") + "/")

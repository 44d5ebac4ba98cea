"""Expressions over JSON texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAP = "map<string,string>"


def is_json(text: Column) -> Column:
    """Whether the whole text is one JSON value: wrapped in a list it has one element, wrapped in an object it parses.
    (Spark's own parsers accept what follows a first complete value.) Null for null."""
    one = F.size(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")) == 1
    whole = F.from_json(F.concat(F.lit('{"w":'), text, F.lit("}")), MAP).isNotNull()
    return F.when(text.isNotNull(), F.coalesce(one & whole, F.lit(False)))


def as_map(text: Column) -> Column:
    """Top-level keys in document order (the last of equal keys wins), null unless the text is one JSON object."""
    return F.when(is_json(text) & F.ltrim(text).startswith("{"), F.from_json(text, MAP))


def field(text: Column, key: str) -> Column:
    """A top-level field as text; null if missing, null or not an object."""
    return as_map(text)[key]


def has_key(text: Column, key: str) -> Column:
    """Whether a valid object has the key, its value null or not."""
    return F.coalesce(F.array_contains(F.map_keys(as_map(text)), key), F.lit(False))


def first_key(m: Column) -> Column:
    return F.try_element_at(F.map_keys(m), F.lit(1))


def first_value(m: Column) -> Column:
    return F.try_element_at(F.map_values(m), F.lit(1))


def body(text: Column) -> Column:
    """From the first { to the last }; null if there is none."""
    begin = F.instr(text, "{")
    end = F.length(text) - F.instr(F.reverse(text), "}") + 1
    return F.when((begin > 0) & (F.instr(text, "}") > 0) & (end >= begin), F.substring(text, begin, end - begin + 1))


def without_trailing_commas(text: Column) -> Column:
    return F.regexp_replace(text, r",\s*([\]}])", "$1")

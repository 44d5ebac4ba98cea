"""Many strings replaced in one pass: leftmost first, the longest of those that begin there."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import Any

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def automaton(pairs: Mapping[str, str]) -> ahocorasick.Automaton | None:
    """An Aho-Corasick automaton over the old strings; none for no strings."""
    built = ahocorasick.Automaton()
    for old, new in pairs.items():
        built.add_word(old, (len(old), new))
    built.make_automaton()
    return built if pairs else None


def _cut(text: str, built: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """Begin, end and new string of what is replaced. Matches come by their ends, so one is certain once no match that ends
    later can begin before it: of those in doubt, only the leftmost and longest is held."""
    best: dict[int, tuple[int, str]] = {}  # begin -> end and new string of the longest match; ends come in order
    for last, (size, new) in built.iter(text):
        best[last + 1 - size] = (last + 1, new)
    out, at = [], 0
    for begin in sorted(best):
        if begin >= at:
            at, new = best[begin]
            out.append((begin, at, new))
    return out


def replace_all(text: str, built: ahocorasick.Automaton | None) -> str:
    """The text with the strings of the automaton replaced."""
    if built is None:
        return text
    out, at = [], 0
    for begin, end, new in _cut(text, built):
        out += (text[at:begin], new)
        at = end
    return "".join((*out, text[at:]))


def pieces(text: str, built: ahocorasick.Automaton | None) -> list[dict[str, str | None]]:
    """The text cut at the strings of the automaton: each with what stands before it, and the rest with none."""
    out, at = [], 0
    for begin, end, _ in _cut(text, built) if built is not None else ():
        out.append({"before": text[at:begin], "old": text[begin:end]})
        at = end
    return [*out, {"before": text[at:], "old": None}]


_KEPT: dict[int, ahocorasick.Automaton | None] = {}


def of_table(table_id: int, table: Any) -> ahocorasick.Automaton | None:
    """The automaton of a broadcast table, built once per worker process; those of two tables are kept."""
    if table_id not in _KEPT:
        while len(_KEPT) > 1:
            _KEPT.pop(next(iter(_KEPT)))
        _KEPT[table_id] = automaton(table.value)
    return _KEPT[table_id]


def replaced(text: Column, table: Any) -> Column:
    """Each text under a broadcast table of old to new strings. Null gives null."""
    table_id = table._jbroadcast.id()

    @F.pandas_udf("string")
    def apply(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        built = of_table(table_id, table)
        for texts in parts:
            yield pd.Series([None if t is None else replace_all(t, built) for t in texts], dtype=object)

    return apply(text)


def replaced_by_own(text: Column, pairs: Column) -> Column:
    """Each text under its own map of old to new strings."""

    @F.pandas_udf("string")
    def apply(texts: pd.Series, maps: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else replace_all(t, automaton(dict(m or {}))) for t, m in zip(texts, maps, strict=True)], dtype=object)

    return apply(text, pairs)


_PIECES = "array<struct<before: string, old: string>>"


def cut(text: Column, table: Any) -> Column:
    """Each text in pieces, at the old strings of a broadcast table. Null gives null."""
    table_id = table._jbroadcast.id()

    @F.pandas_udf(_PIECES)
    def apply(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        built = of_table(table_id, table)
        for texts in parts:
            yield pd.Series([None if t is None else pieces(t, built) for t in texts], dtype=object)

    return apply(text)


def cut_by_own(text: Column, olds: Column) -> Column:
    """Each text in pieces, at its own old strings."""

    @F.pandas_udf(_PIECES)
    def apply(texts: pd.Series, own: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else pieces(t, automaton({o: o for o in ([] if olds is None else olds)})) for t, olds in zip(texts, own, strict=True)], dtype=object)

    return apply(text, olds)

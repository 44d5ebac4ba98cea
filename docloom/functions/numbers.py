"""Expressions over numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def close(a: Column, b: Column | float, absolute: float, relative: float = 1e-9) -> Column:
    b = b if isinstance(b, Column) else F.lit(b)
    return F.abs(a - b) <= F.greatest(F.lit(relative) * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))


def round_to_step(v: Column, step: float) -> Column:
    """To the nearest multiple of `step` (halves to even), modulo 360."""
    return F.pmod(F.bround(v / step, 0) * step, F.lit(360.0))


def padded(number: Column, width: int) -> Column:
    """The number with zeros before it up to a width; longer ones whole (`lpad` would cut them)."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def joined_id(key: Column, number: Column, width: int = 2) -> Column:
    """The deck key followed by the last digits of the number: 123 and 7 make 12307."""
    digits = F.right(F.lpad(number.cast("string"), F.greatest(F.length(number.cast("string")), F.lit(width)), F.lit("0")), F.lit(width))
    return F.concat(key.cast("string"), digits).try_cast("bigint")

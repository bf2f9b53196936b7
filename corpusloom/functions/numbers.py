"""Small numeric and key helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


NUMERAL = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def safe_float(col: Column, default: float = 0.0) -> Column:
    """Double value of ``col``; text, NaN and infinities become ``default``."""
    text = F.trim(col.cast("string"))
    number = F.when(text.rlike(NUMERAL), text).try_cast("double")
    finite = number.isNotNull() & (F.abs(number) != float("inf"))
    return F.when(finite, number).otherwise(F.lit(float(default)))


def order_key(key: Column, seed: int = 42) -> Column:
    """Reproducible pseudo-random order key (32 hex digits)."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def ratio(num: Column, den: Column) -> Column:
    """``num / den``; 0 where the denominator is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num / F.when(den == 0, F.lit(None)).otherwise(den))


def r6(col: Column) -> Column:
    return F.round(col, 6)

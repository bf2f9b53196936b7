"""Reproducible samples and splits that never sort a whole group in one task.

Every row gets a hash key (md5 of id and seed).  "The first n rows in key
order" is found in two scans: a histogram over key prefixes gives, per group,
the one prefix where the n-th row falls; rows before it are in, rows after it
are out, and only the rows sharing that prefix (1/65536 of a group) are
ranked by a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import order_key
from .terms import attach

PREFIX_DIGITS = 4


def mark_first(df: DataFrame, want: Column, by: Sequence[str] = (), key: str = "doc_id",
               seed: int = 42, flag: str = "chosen") -> DataFrame:
    """Adds a boolean ``flag``: the row is among the first ``want`` of its group.

    ``want`` is an expression over ``n``, the size of the group.
    """
    by = list(by)
    hashed = df.withColumn("_key", order_key(F.col(key), seed)).withColumn(
        "_prefix", F.left(F.col("_key"), F.lit(PREFIX_DIGITS)))
    histogram = hashed.groupBy(*by, "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*by)  # at most 16**PREFIX_DIGITS rows per group
    running = group.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        histogram.withColumn("n", F.sum("_n").over(group))
        .withColumn("_upto", F.sum("_n").over(running))
        .withColumn("_want", want)
        .filter((F.col("_want") > F.col("_upto") - F.col("_n")) & (F.col("_want") <= F.col("_upto")))
        .select(*by, F.col("_prefix").alias("_cut"),
                (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_rest"))
    )
    if by:
        # one row per group
        joined = hashed.join(cut, by, "left")
    else:
        one = cut.agg(F.first("_cut").alias("_cut"), F.first("_rest").alias("_rest"))
        joined = attach(hashed, one)
    at_cut = joined.filter(F.col("_prefix") == F.col("_cut"))
    ranked = at_cut.withColumn("_rank", F.row_number().over(
        Window.partitionBy(*by, "_prefix").orderBy("_key", key)))
    inside = ranked.withColumn(flag, F.col("_rank") <= F.col("_rest")).select(*df.columns, flag)
    elsewhere = joined.filter(F.col("_cut").isNull() | (F.col("_prefix") != F.col("_cut")))
    outside = elsewhere.withColumn(
        flag, F.coalesce(F.col("_prefix") < F.col("_cut"), F.lit(False))).select(*df.columns, flag)
    return inside.unionByName(outside)


def sample_exact(df: DataFrame, n: int, key: str = "doc_id", seed: int = 42) -> DataFrame:
    """Exactly ``min(n, count)`` rows, in no particular order."""
    want = F.least(F.lit(n).cast("long"), F.col("n"))
    return mark_first(df, want, (), key, seed).filter("chosen").drop("chosen")


def split(df: DataFrame, test_fraction: float = 0.2, by: Sequence[str] = ("label",),
          key: str = "doc_id", seed: int = 42) -> DataFrame:
    """Adds ``part``: the first ``ceil(test_fraction * n)`` rows per group are ``test``."""
    want = F.ceil(F.col("n") * F.lit(test_fraction)).cast("long")
    marked = mark_first(df, want, by, key, seed, "_test")
    return marked.withColumn("part", F.when(F.col("_test"), "test").otherwise("train")).drop("_test")

"""Running sums and exact order statistics of groups of any size.

No window spans a whole group and no state holds its values: rows are dealt to parts by
range, parts are summed, a scan over the parts gives what lies before each, and sums run
inside the parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

#: Cells of a group's histogram; only the cells that hold a wanted rank are looked at value by value.
CELLS = 1024


def running_sums(df: DataFrame, sums: Sequence[str], order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """Adds ``before_<c>``: the sum of ``c`` over the rows of the group that come earlier in ``order``.

    ``order`` has to tell the rows of a group apart; ``sums`` are not null.  The scan over
    parts sees one row a part and group in it: parts plus groups, whatever the rows.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # settled: the part of a row must not change between the sums and the scan
    placed = settle(df.repartitionByRange(n, *by, *order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*by, "_part").agg(*[F.sum(c).alias(c) for c in sums])
    first = totals.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_at"), *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"_{c}") for c in sums])
    within = placed.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"before_{c}") for c in sums])
    joined = within.join(first, [*[within[c].eqNullSafe(first[f"_by_{c}"]) for c in by], within["_part"] == first["_at"]])
    return joined.select(*df.columns, *[(F.col(f"before_{c}") + F.col(f"_{c}")).alias(f"before_{c}") for c in sums])


def quantiles(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (), cells: int = CELLS) -> DataFrame:
    """One row a group: ``n``, and by the names of ``probs`` the interpolated quantiles of ``value``.

    Exact at any size: a histogram between the group's least and largest value finds the
    cells of the wanted ranks, and only these cells' distinct values are counted and
    ordered.  Nulls and NaN are left out; a group without values gives nulls.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("_v"))
    usable = F.when(F.isnan("_v"), None).otherwise(F.col("_v"))
    rows = rows.withColumn("_v", usable)
    ends = rows.groupBy(*by).agg(F.count("_v").alias("n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    known = rows.filter("_v IS NOT NULL")
    same = [known[c].eqNullSafe(ends[c]) for c in by]
    spread = known.join(ends, same) if by else known.crossJoin(F.broadcast(ends))
    place = F.when(F.col("_high") > F.col("_low"), F.least(F.lit(cells - 1), F.floor((F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low")) * cells)))
    celled = spread.select(*[known[c] for c in by], "_v", F.coalesce(place, F.lit(0)).cast("int").alias("_cell"), "n")
    counted = settle(celled.groupBy(*by, "_cell", "_v", "n").agg(F.count(F.lit(1)).alias("_many")))
    ahead = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    held = counted.groupBy(*by, "_cell", "n").agg(F.sum("_many").alias("_held"))
    held = held.withColumn("_ahead", F.coalesce(F.sum("_held").over(ahead), F.lit(0)))

    def ranks(p: float) -> tuple[Column, Column]:
        at = (F.col("n") - 1) * F.lit(p)
        return F.floor(at), F.ceil(at)

    wanted = [r for p in probs.values() for r in ranks(p)]
    has = F.lit(False)
    for r in wanted:
        has = has | ((r >= F.col("_ahead")) & (r < F.col("_ahead") + F.col("_held")))
    cut = held.filter(has).select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_cell").alias("_at"), "_ahead")
    match = [counted[c].eqNullSafe(cut[f"_by_{c}"]) for c in by]
    inside = counted.join(cut, [*match, counted["_cell"] == cut["_at"]]).select(*[counted[c] for c in by], "_cell", "_v", "n", "_many", "_ahead")
    ordered = running_sums(inside, ["_many"], [F.col("_v")], [*by, "_cell"])
    first = F.col("_ahead") + F.col("before__many")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= first) & (rank < first + F.col("_many")), F.col("_v")))

    ends_of = [x for name, p in probs.items() for x in (at(ranks(p)[0]).alias(f"_lo_{name}"), at(ranks(p)[1]).alias(f"_hi_{name}"))]
    found = ordered.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(*ends_of)

    def between(name: str, p: float) -> Column:
        part = (F.col("n") - 1) * F.lit(p)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        return (low + (high - low) * (part - F.floor(part))).alias(name)

    both = ends.join(found, [ends[c].eqNullSafe(found[f"_by_{c}"]) for c in by], "left") if by else ends.crossJoin(F.broadcast(found))
    return both.select(*[ends[c] for c in by], "n", *[between(name, p) for name, p in probs.items()])

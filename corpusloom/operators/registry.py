"""Model registry rules over run and version tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import safe_float
from ..session import settle
from .terms import top_per_group

#: A challenger must beat the champion by this much.
MARGIN = 0.01
#: Versions per block when looking for running records; records folded at a time.
BLOCK = 10000


def records(versions: DataFrame, by: str = "model_name", order: str = "version",
            score: str = "f1", block: int = BLOCK) -> DataFrame:
    """Rows whose score is strictly above every earlier one of the model.

    Blocks of versions are scanned in parallel; the maximum of earlier blocks
    then filters each block's own records.  A model with very many versions
    is never gathered in one task.
    """
    blocked = versions.withColumn("_block", F.floor(F.col(order) / block))
    earlier = Window.partitionBy(by, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = (blocked.withColumn("_best", F.max(score).over(earlier))
             .filter(F.col("_best").isNull() | (F.col(score) > F.col("_best"))).drop("_best"))
    blocks = blocked.groupBy(by, "_block").agg(F.max(score).alias("_max"))
    before = Window.partitionBy(by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    prior = blocks.select(by, "_block", F.max("_max").over(before).alias("_prior"))
    return (local.join(prior, [by, "_block"])
            .filter(F.col("_prior").isNull() | (F.col(score) > F.col("_prior")))
            .drop("_block", "_prior"))


def promotions(versions: DataFrame, by: str = "model_name", order: str = "version",
               score: str = "f1", margin: float = MARGIN, head: int = BLOCK) -> DataFrame:
    """Adds ``stage`` by replaying champion/challenger promotion in version order.

    The first version becomes Production; a later one replaces it if its score
    is at least the champion's plus ``margin``; replaced ones are Archived and
    the rest stay in Staging.  Scores are compared as they are.

    Only running records can ever be promoted (a version that does not exceed
    an earlier score cannot exceed the champion by the margin).  They are folded
    ``head`` of a model at a time, so no state grows with the versions; records
    within the margin of the new champion drop out before the next round.
    """
    kind, value = dict(versions.dtypes)[order], F.col(score).cast("double")
    left = settle(records(versions.select(by, order, value.alias(score)), by, order, score))
    champions = versions.select(by).distinct().select(by, F.lit(None).cast(kind).alias("_v"), F.lit(float("-inf")).alias("_f"))
    won = None

    def step(acc: Column, r: Column) -> Column:
        better = r["f"] >= acc["f"] + margin
        return F.struct(F.when(better, F.concat(acc["won"], F.array(r["v"]))).otherwise(acc["won"]).alias("won"),
                        F.when(better, r["f"]).otherwise(acc["f"]).alias("f"), r["v"].alias("v"))

    while True:
        first = top_per_group(left.withColumn("_down", -F.col(order)), [by], "_down", [order], head, "_at")
        taken = first.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("v"), F.col(score).alias("f")))).alias("r"))
        start = F.struct(F.array().cast(f"array<{kind}>").alias("won"), F.col("_f").alias("f"), F.col("_v").alias("v"))
        folded = settle(taken.join(champions, by).select(by, F.aggregate("r", start, step).alias("a")))
        some = folded.select(by, F.explode("a.won").alias(order))
        won = some if won is None else won.unionByName(some)
        champions = folded.select(by, F.col("a.v").alias("_v"), F.col("a.f").alias("_f"))
        left = settle(left.join(champions, by).filter((F.col(order) > F.col("_v")) & (F.col(score) >= F.col("_f") + margin)).drop("_v", "_f"))
        if left.isEmpty():
            break
    last = won.groupBy(by).agg(F.max(order).alias("_last"))
    champion = won.join(last, by)
    return versions.join(champion, [by, order], "left").withColumn(
        "stage", F.when(F.col("_last").isNull(), "Staging")
        .when(F.col("_last") == F.col(order), "Production").otherwise("Archived")).drop("_last")


def serving_version(staged: DataFrame, by: str = "model_name", order: str = "version") -> DataFrame:
    """The production version per model, else the latest one."""
    rank = F.struct((F.col("stage") == "Production").cast("int").alias("p"), F.col(order).alias("v"))
    return staged.groupBy(by).agg(F.max_by(F.struct(order, "stage"), rank).alias("s")).select(by, "s.*")


def best_per_family(runs: DataFrame, by: str = "family", score: str = "f1", order: str = "run_order") -> DataFrame:
    """Highest score per family; the earliest run wins ties."""
    return runs.groupBy(by).agg(
        F.max_by(F.struct(order, score), F.struct(F.col(score), -F.col(order))).alias("b")).select(by, "b.*")


def recent_runs(runs: DataFrame, n: int = 10, start: str = "start_time", tie: str = "run_id") -> DataFrame:
    return runs.orderBy(F.desc(start), tie).limit(n)


def history(versions: DataFrame, runs: DataFrame, metrics: Sequence[str] = ("weighted_f1", "accuracy", "roc_auc")) -> DataFrame:
    """Versions with their metrics: the version's own tag, else its run's value, else 0."""
    run = runs.select("run_id", *[F.col(m).alias(f"_run_{m}") for m in metrics])
    joined = versions.join(run, "run_id", "left")
    return joined.select(
        *[c for c in versions.columns if c not in metrics],
        *[safe_float(F.coalesce(F.col(m).cast("string"), F.col(f"_run_{m}").cast("string"))).alias(m)
          for m in metrics])


def performance_report(versions: DataFrame, runs: DataFrame, n: int = 10,
                       metrics: Sequence[str] = ("weighted_f1", "accuracy", "roc_auc")) -> DataFrame:
    """One table of what serves, what was registered and what ran last.

    ``part`` is ``serving`` (the version each model serves with), ``version`` (all, with
    metrics) or ``run`` (the ``n`` latest); ``rank`` orders each part.  ``versions`` has a
    stage for every row.
    """
    known = history(versions, runs, metrics)
    served = serving_version(versions).select("model_name", "version")
    number = Window.partitionBy("model_name").orderBy(F.desc("version"))
    rows = known.select("model_name", F.col("version").cast("string").alias("name"), "stage", "run_id", *metrics, F.row_number().over(number).alias("rank"))
    best = served.select("model_name", F.col("version").cast("string").alias("name")).join(rows, ["model_name", "name"])
    late = recent_runs(runs, n)  # at most n rows
    last = late.select(F.col("experiment").alias("model_name"), F.col("run_name").alias("name"), F.lit(None).cast("string").alias("stage"), "run_id",
                       *metrics, F.row_number().over(Window.orderBy(F.desc("start_time"), "run_id")).alias("rank"))
    return (best.withColumn("part", F.lit("serving")).withColumn("rank", F.lit(1))
            .unionByName(rows.withColumn("part", F.lit("version"))).unionByName(last.withColumn("part", F.lit("run")))
            .select("part", "rank", "model_name", "name", "stage", "run_id", *metrics))


def run_sources(docs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct sorted sources as JSON; distinct rows first, so sets stay small."""
    return docs.select(*by, "source").distinct().groupBy(*by).agg(
        F.to_json(F.array_sort(F.collect_list("source"))).alias("sources"))

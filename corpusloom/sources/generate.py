"""Template sentences: subject, verb, object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import TEMPLATE_OBJECTS, TEMPLATE_SUBJECTS, TEMPLATE_VERBS
from ..functions.numbers import order_key


def _pick(words: list[str], key: Column, offset: int) -> Column:
    """A reproducible choice from ``words`` by two hex digits of the key."""
    digits = F.conv(F.substring(key, offset, 2), 16, 10).cast("int")
    return F.element_at(F.array(*[F.lit(w) for w in words]), digits % len(words) + 1)


def sentences(ids: DataFrame, id_col: str = "id", seed: int = 42) -> DataFrame:
    """One labelled template sentence per id."""
    key = order_key(F.col(id_col), seed)
    return ids.select(
        F.col(id_col),
        F.concat_ws(" ", _pick(TEMPLATE_SUBJECTS, key, 1), _pick(TEMPLATE_VERBS, key, 3),
                    _pick(TEMPLATE_OBJECTS, key, 5)).alias("text"),
        F.lit("fake").alias("label"))


def generate(spark: SparkSession, n: int = 2000, seed: int = 42) -> DataFrame:
    """Distinct ``text, label`` rows out of ``n`` draws (at most 216)."""
    return sentences(spark.range(n), "id", seed).select("text", "label").dropDuplicates()


def grid(spark: SparkSession) -> DataFrame:
    """Every sentence of the template (three explodes of fixed word lists)."""
    def words(name: str, items: list[str]) -> Column:
        return F.explode(F.array(*[F.lit(w) for w in items])).alias(name)

    rows = spark.range(1).select(words("s", TEMPLATE_SUBJECTS)).select("s", words("v", TEMPLATE_VERBS)).select(
        "s", "v", words("o", TEMPLATE_OBJECTS))
    return rows.select(F.concat_ws(" ", "s", "v", "o").alias("text"), F.lit("fake").alias("label"))

"""Registration, table access and the frames several queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..functions.tokens import tokenize
from ..operators import sampling, terms
from ..session import once, settle, spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, data: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data}/{name}.parquet")


_shared: dict[tuple[str, str, str], DataFrame] = {}


def shared(spark: SparkSession, data: str, name: str,
           build: Callable[[], DataFrame]) -> DataFrame:
    """A frame that many queries start from, computed at its first use."""
    key = (spark.sparkContext.applicationId, data, name)
    if key not in _shared:
        _shared[key] = settle(build())
    return _shared[key]


def labelled_raw(spark: SparkSession, data: str) -> DataFrame:
    """``doc_id, text, label, source`` of the labelled documents.

    No join hint: Spark broadcasts the labels while they are small and sorts
    and merges beyond that.
    """
    docs = table(spark, data, "documents").select("doc_id", "text", "source")
    labels = table(spark, data, "labels").select(
        "doc_id", F.when(F.col("quality") == 0, "fake").when(F.col("quality") == 1, "real").alias("label"))
    return docs.join(labels.filter(F.col("label").isNotNull()), "doc_id")


def labelled(spark: SparkSession, data: str) -> DataFrame:
    """Cleaned labelled corpus with its word tokens.

    The one shuffle by ``doc_id`` comes before the cleaning: it evens out the
    work over the tasks, and later per-document steps need no other.  Each
    labelled text is cleaned once, and no other one.  Kept is the text; its words,
    which would take three times as much, are cut anew where they are used.
    """
    kept = shared(spark, data, "labelled", lambda: (
        spread(labelled_raw(spark, data), "doc_id")
        .select("doc_id", "label", "source", once(clean_text(F.col("text"))).alias("clean_text")).filter(F.col("clean_text") != "")))
    return kept.withColumn("tokens", tokenize(F.col("clean_text"), "word"))


def documents(spark: SparkSession, data: str) -> DataFrame:
    """All documents, cleaned, with their word tokens; as in :func:`labelled` the text is kept."""
    kept = shared(spark, data, "documents", lambda: (
        spread(table(spark, data, "documents").select("doc_id", "source", "text"), "doc_id")
        .select("doc_id", "source", clean_text(F.col("text")).alias("clean_text"))))
    return kept.withColumn("tokens", tokenize(F.col("clean_text"), "word"))


def labelled_terms(spark: SparkSession, data: str) -> DataFrame:
    """``doc_id, label, terms, tfs`` of the labelled documents."""
    return shared(spark, data, "labelled_terms", lambda: terms.packed(labelled(spark, data), keep=["label"]))


def labelled_postings(spark: SparkSession, data: str) -> DataFrame:
    return terms.unpacked(labelled_terms(spark, data), ["label"])


def document_terms(spark: SparkSession, data: str) -> DataFrame:
    """``doc_id, terms, tfs`` of all documents; texts and tokens are not kept for it."""
    return shared(spark, data, "document_terms", lambda: terms.packed(
        spread(table(spark, data, "documents").select("doc_id", "text"), "doc_id")
        .select("doc_id", once(tokenize(clean_text(F.col("text")), "word")).alias("tokens"))))


def document_postings(spark: SparkSession, data: str) -> DataFrame:
    return terms.unpacked(document_terms(spark, data))


def labelled_split(spark: SparkSession, data: str) -> DataFrame:
    """``doc_id, label, part`` of the stratified split."""
    return shared(spark, data, "labelled_split", lambda: sampling.split(
        labelled(spark, data).select("doc_id", "label")))

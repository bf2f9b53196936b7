"""Corpus preparation: text assembly, label rules, filters, validation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import LABELS
from ..functions.text import clean_text, is_blank

# --- fixed values: six-way truth labels folded to two ------------------------
FOLD_TO_REAL = ["true", "mostly-true"]
FOLD_TO_FAKE = ["half-true", "barely-true", "false", "pants-fire"]


def normalise_header(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def assemble_text(df: DataFrame, names: Sequence[str]) -> Column | None:
    """The non-null columns out of ``names``, in file order, joined by a space."""
    wanted = set(names)
    present = [c for c in df.columns if c in wanted]
    return F.concat_ws(" ", *[F.col(f"`{c}`") for c in present]) if present else None


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~is_blank(F.col(column)))


def fold_label(label: Column) -> Column:
    """Six truth labels to two; unknown labels become null."""
    norm = F.lower(F.trim(label))
    return F.when(norm.isin(FOLD_TO_REAL), F.lit("real")).when(norm.isin(FOLD_TO_FAKE), F.lit("fake"))


def normalise_labels(df: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Lower-cased, trimmed labels; rows outside the closed domain go."""
    return (df.withColumn("label", F.lower(F.trim(F.col("label").cast("string"))))
            .filter(F.col("label").isin(*labels)))


def add_clean_text(df: DataFrame, text: str = "text", out: str = "clean_text") -> DataFrame:
    """Adds the cleaned text and drops rows that clean to nothing."""
    return drop_blank(df.withColumn(out, clean_text(F.col(text))), out)


def prepare(df: DataFrame) -> DataFrame:
    """Clean, drop blanks, close the label domain."""
    return normalise_labels(add_clean_text(df.filter(F.col("text").isNotNull())))


def require_rows(df: DataFrame) -> DataFrame:
    """Fails early on an empty corpus."""
    if df.isEmpty():
        raise ValueError("no dataset rows available")
    return df


def combine(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def overview(df: DataFrame) -> DataFrame:
    """Documents, class counts and shares, sources, mean words; total row last.

    One partial aggregation per source; the total row re-aggregates those few
    rows instead of expanding every input row for a rollup.
    """
    per = df.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum((F.col("label") == "fake").cast("long")).alias("fake"),
        F.sum((F.col("label") == "real").cast("long")).alias("real"),
        F.sum(F.size(F.split(F.trim(F.col("clean_text")), " +")).cast("long")).alias("words"))
    total = per.groupBy().agg(
        F.lit("TOTAL").alias("source"),
        *[F.sum(c).alias(c) for c in ("documents", "fake", "real", "words")],
        F.count(F.lit(1)).alias("sources"))
    rows = per.withColumn("sources", F.lit(1).cast("long")).unionByName(total)
    docs = F.col("documents")
    return rows.select(
        "source", "documents", "fake", "real", "sources",
        F.round(F.col("fake") * 100.0 / docs, 6).alias("fake_pct"),
        F.round(F.col("real") * 100.0 / docs, 6).alias("real_pct"),
        F.round(F.col("words") / docs, 6).alias("avg_words"))


# --- request validation ------------------------------------------------------

# --- fixed values: limits on requests ------------------------------------------
TEXT_LENGTH = (10, 10000)
BATCH_SIZE = (1, 100)
TOP_K = (1, 20)
MIN_TOKEN_LENGTH = (1, 20)
TOKENIZERS = ["custom", "nltk", "spacy"]
STOPWORD_LISTS = ["none", "default", "custom"]
NORMALIZATIONS = ["none", "porter", "snowball", "lemmatizer"]


def _outside(col: Column, bounds: tuple[int, int]) -> Column:
    return col.isNull() | (col < bounds[0]) | (col > bounds[1])


def reject_reason(text: Column | None = None, batch: Column | None = None,
                  top_k: Column | None = None, min_token_length: Column | None = None,
                  tokenizer: Column | None = None, stopword_list: Column | None = None,
                  normalization: Column | None = None) -> Column:
    """First broken rule of a request as text, null when it is valid."""
    length = F.char_length
    rules: list[tuple[Column, str]] = []
    if text is not None:
        rules += [(text.isNull(), "text_missing"),
                  (length(text) < TEXT_LENGTH[0], "text_too_short"),
                  (length(text) > TEXT_LENGTH[1], "text_too_long")]
    if batch is not None:
        rules += [(_outside(F.size(batch), BATCH_SIZE), "batch_size"),
                  (F.exists(batch, lambda t: t.isNull() | (length(t) < TEXT_LENGTH[0])
                            | (length(t) > TEXT_LENGTH[1])), "batch_item_length")]
    if top_k is not None:
        rules.append((_outside(top_k, TOP_K), "top_k"))
    if min_token_length is not None:
        rules.append((_outside(min_token_length, MIN_TOKEN_LENGTH), "min_token_length"))
    for col, domain, name in ((tokenizer, TOKENIZERS, "tokenizer"),
                              (stopword_list, STOPWORD_LISTS, "stopword_list"),
                              (normalization, NORMALIZATIONS, "normalization")):
        if col is not None:
            rules.append((~F.coalesce(col.isin(domain), F.lit(False)), name))
    branch = None
    for broken, name in rules:
        branch = F.when(broken, F.lit(name)) if branch is None else branch.when(broken, F.lit(name))
    return branch if branch is not None else F.lit(None).cast("string")


def split_valid(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with their ``reject_reason``."""
    marked = df.withColumn("reject_reason", reason)
    return (marked.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            marked.filter(F.col("reject_reason").isNotNull()))

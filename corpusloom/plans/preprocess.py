"""Configured preprocessing of a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tokens as tk
from ..functions.stems import stem_array, stem_column
from ..functions.text import clean_text
from ..operators.audit import lemmas
from ..operators.lookup import replaced
from ..session import settle
from .config import Setup


def lemmatise_array(df: DataFrame, tokens: str, lexicon: DataFrame | None = None) -> DataFrame:
    """Replaces tokens by their lemmas, keeping order.

    Rows are matched by a digest of their tokens, so equal token lists meet the lexicon
    once and rows need no key.  Only distinct terms that change take part in the join.
    The rows are settled first: what comes before runs once, though it is read for the
    vocabulary, the changes and the result.  Without ``lexicon`` (column ``term``) the
    words of the rows themselves serve as one.
    """
    held = settle(df.withColumn("_key", F.md5(F.concat_ws("\x1f", tokens))))
    pairs = held.dropDuplicates(["_key"]).select("_key", F.explode(F.array_distinct(tokens)).alias("term"))
    vocab = pairs.select("term").distinct()
    changed = lemmas(vocab, vocab if lexicon is None else lexicon).filter(F.col("lemma") != F.col("term"))
    maps = pairs.join(changed, "term").groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("term", "lemma"))).alias("_map"))
    swapped = F.transform(tokens, lambda t: F.coalesce(F.col("_map")[t], t))
    return held.join(maps, "_key", "left").withColumn(
        tokens, F.when(F.col("_map").isNull(), F.col(tokens)).otherwise(swapped)).drop("_map", "_key")


def split_words(df: DataFrame, setup: Setup, text: str = "text", cleaned: str | None = None, removed: bool = True) -> DataFrame:
    """Adds ``_clean`` (without ``cleaned``), ``tokens`` and ``removed_stopwords`` (unless not wanted): cut and without stopwords, not yet reduced."""
    base = df if cleaned else df.withColumn("_clean", clean_text(F.col(text)))
    work = base.withColumn("_all", tk.tokenize(F.col(cleaned or "_clean"), setup.tokens.tokenizer))
    if removed:
        work = work.withColumn("removed_stopwords", tk.removed_stopwords(F.col("_all"), setup.tokens.stopword_list))
    return work.withColumn("tokens", tk.remove_stopwords(F.col("_all"), setup.tokens.stopword_list)).drop("_all")


def lexicon_of(df: DataFrame, setup: Setup, text: str = "text", cleaned: str | None = None) -> DataFrame:
    """``term``: the distinct words the lemmatiser looks its candidates up in, where a corpus serves as lexicon."""
    return split_words(df, setup, text, cleaned).select(F.explode("tokens").alias("term")).distinct()


def preprocess(df: DataFrame, setup: Setup, text: str = "text", cleaned: str | None = None,
               lexicon: DataFrame | None = None, removed: bool = True) -> DataFrame:
    """Adds ``processed_text``, ``tokens`` and ``removed_stopwords`` (unless not wanted).

    Without a normaliser this is one projection.  A stemmer stems each different
    word of a batch once; of a stream, each word where it stands.  The
    lemmatiser needs ``lexicon`` (column ``term``); by default the words of
    the corpus itself serve as lexicon.
    """
    work = split_words(df, setup, text, cleaned, removed)
    if setup.tokens.normalization in ("porter", "snowball"):
        work = (work.withColumn("tokens", stem_array(F.col("tokens"), setup.tokens.normalization)) if df.isStreaming
                else replaced(work, "tokens", lambda words: stem_column(words, "word", setup.tokens.normalization, "form")))
    elif setup.tokens.normalization == "lemmatizer":
        work = lemmatise_array(work, "tokens", lexicon)
    elif setup.tokens.normalization != "none":
        raise ValueError(f"unknown normalization: {setup.tokens.normalization}")
    kept = tk.keep_long(F.col("tokens"), setup.tokens.min_token_length)
    work = work.withColumn("tokens", tk.or_fallback(kept, F.col(cleaned or "_clean"))).drop(*([] if cleaned else ["_clean"]))
    return work.withColumn("processed_text", F.array_join("tokens", " "))

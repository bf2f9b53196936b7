"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import contamination, divergence, minhash, pieces, pii, quality, rules, sentences, simhash, spelling, sql, suffix, tokencount, tokenfile
from .common import shared_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op11_minhash": sql.MINHASH, "op12_spelling": sql.SPELLING, "op13_divergence": sql.DIVERGENCE}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = rules.trusted_ids(table(spark, sf_dir, "labels"))
    return rules.judge(table(spark, sf_dir, "documents"), trusted)


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(pieces.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")))


@query
def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files go to a new folder in the shared folder, then are read back."""
    path = shared_path(spark, "tokens")
    tokenfile.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return tokenfile.digest(tokenfile.read_back(spark, path))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache in the shared folder."""
    cache = shared_path(spark, "token-counts")
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), cache)


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.flag(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.drop_repeats(table(spark, sf_dir, "documents"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(suffix.remaining(table(spark, sf_dir, "documents")))


@query
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))

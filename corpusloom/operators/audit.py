"""Noise audit, tokeniser comparison, stopword rates, vocabulary checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.fixed import ROMAN_URDU, stopwords
from ..functions.numbers import ratio
from ..functions.tokens import WORD, in_list, tokenize
from ..session import settle
from .ordered import quantiles

FLAGS = {"html_tags": tx.TAG, "urls": tx.URL, "handles": tx.HANDLE, "emojis": tx.EMOJI,
         "repeated_punctuation": tx.REPEATED_PUNCT}
NOISE_COLUMNS = [*FLAGS, "roman_urdu_terms", "before_length", "after_length"]


def word_count(col: Column) -> Column:
    """Number of runs between spaces."""
    return F.size(F.regexp_extract_all(col, F.lit(rf"[^{tx.SPACES}]+"), F.lit(0)))


def dictionary_count(tokens: Column) -> Column:
    return F.size(F.filter(tokens, lambda t: in_list(t, sorted(ROMAN_URDU))))


def noise_audit(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """Per-document noise flags and word counts before and after cleaning."""
    col = F.col(text)
    found = F.regexp_extract_all(col, F.lit(WORD), F.lit(0))
    return df.select(
        *keep,
        *[col.rlike(p).cast("int").alias(n) for n, p in FLAGS.items()],
        dictionary_count(found).alias("roman_urdu_terms"),
        word_count(col).alias("before_length"),
        word_count(tx.clean_text(col)).alias("after_length"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max per column, long form.

    Quartiles are exact and come from a histogram and the values of three cells; no
    state holds a column's values.  The columns are computed once, for all passes.
    """
    df = settle(df.select(*columns))
    pairs = ", ".join(f"'{c}', cast({c} as double)" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {pairs}) as (metric, value)")
    moments = long.groupBy("metric").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    quarts = quantiles(long, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["metric"]).drop("n")
    both = moments.join(quarts, "metric")
    return both.select("metric", "count", *[F.round(c, 6).alias(c) for c in (
        "mean", "std", "min", "q25", "q50", "q75", "max")])


def oov_by_document(tokens: DataFrame, lexicon: DataFrame, keys: Sequence[str],
                    marks: Mapping[str, Column] | None = None) -> DataFrame:
    """Share of a document's tokens that are alphabetic and not in the lexicon.

    ``tokens`` has one row per (keys, token) with a count ``tf``.  Counting
    before the join keeps frequent words to one row per document.  ``marks`` names
    further conditions whose tokens are counted.
    """
    known = lexicon.select(F.col("term").alias("token")).distinct().withColumn("known", F.lit(True))
    alpha = F.col("token").rlike(r"^\p{L}+$")
    joined = tokens.withColumn("_lower", F.lower("token")).join(
        known.withColumnRenamed("token", "_lower"), "_lower", "left")
    return joined.groupBy(*keys).agg(
        F.sum("tf").alias("tokens"),
        F.sum(F.when(alpha & F.col("known").isNull(), F.col("tf")).otherwise(0)).alias("unknown"),
        *[F.sum(F.when(c, F.col("tf")).otherwise(0)).alias(n) for n, c in (marks or {}).items()],
    ).withColumn("oov_rate", ratio(F.col("unknown"), F.col("tokens")))


def compare_tokenizers(docs: DataFrame, lexicon: DataFrame, text: str = "clean_text",
                       methods: Sequence[str] = ("custom", "word", "treebank")) -> DataFrame:
    """Averages per document of tokens, OOV rate, contractions, dictionary words.

    Counts come from the rows themselves.  For the unknown words a document's words are
    counted once for all methods, and only alphabetic ones meet the lexicon.
    """
    named = F.explode(F.array(*[F.lit(m) for m in methods])).alias("method")
    counts = docs.select(named, F.col(text).isNotNull().alias("_known")).groupBy("method").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if("_known").alias("_known"))
    cut = docs.select("doc_id", *[tokenize(F.col(text), m).alias(m) for m in methods])
    stacked = cut.select("doc_id", F.explode(F.array(*[F.struct(F.lit(m).alias("method"), F.col(m).alias("toks")) for m in methods])).alias("m")).select(
        "doc_id", "m.method", "m.toks").filter(F.size("toks") > 0)
    marks = {"contractions": lambda t: t.contains("'"), "roman_terms": lambda t: in_list(t, sorted(ROMAN_URDU))}
    # rows of one key are one document; only the share of unknown words takes a look at the lexicon
    sizes = stacked.groupBy("doc_id", "method").agg(F.sum(F.size("toks")).alias("tokens"), *[
        F.sum(F.size(F.filter("toks", mark))).alias(n) for n, mark in marks.items()])

    def alphabetic(number: int, method: str) -> Column:
        return F.transform(F.filter(method, lambda t: t.rlike(r"^\p{L}+$")), lambda t: F.struct(F.lower(t).alias("term"), F.lit(number).alias("at")))

    words = cut.select("doc_id", F.explode(F.flatten(F.array(*[F.coalesce(alphabetic(i, m), F.array().cast("array<struct<term: string, at: int>>")) for i, m in enumerate(methods)]))).alias("w"))
    counted = words.groupBy("doc_id", "w.term").agg(*[F.count_if(F.col("w.at") == i).alias(f"n_{i}") for i in range(len(methods))])
    unknown = counted.join(lexicon.select("term").distinct(), "term", "left_anti").groupBy("doc_id").agg(*[F.sum(f"n_{i}").alias(f"n_{i}") for i in range(len(methods))])
    unknown = unknown.select(F.col("doc_id").alias("_doc"), F.explode(F.array(*[F.struct(F.lit(m).alias("_method"), F.col(f"n_{i}").alias("unknown")) for i, m in enumerate(methods)])).alias("u")).select("_doc", "u.*")
    per_doc = sizes.join(unknown, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("method") == F.col("_method")), "left").withColumn(
        "oov_rate", ratio(F.coalesce("unknown", F.lit(0)), F.col("tokens")))
    sums = per_doc.groupBy("method").agg(*[F.sum(c).alias(c) for c in ("oov_rate", "tokens", *marks)])
    return counts.join(sums, "method", "left").select(
        "method", "documents", *[
            F.when(F.col("_known") > 0, F.round(F.coalesce(c, F.lit(0)) / F.col("_known"), 6)).alias(f"avg_{c}")
            for c in ("tokens", "contractions", "roman_terms")],
        F.round(F.coalesce("oov_rate", F.lit(0.0)) / F.col("documents"), 6).alias("avg_oov_rate"))


def removal_rates(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Corpus-level share of tokens each stopword list removes."""
    sizes = [F.sum(F.size(tokens)).alias("tokens")] + [
        F.sum(_removed(tokens, n)).alias(f"removed_{n}") for n in ("default", "custom")]
    one = docs.agg(*sizes)
    return one.select("tokens", "removed_default", "removed_custom", *[
        F.round(ratio(F.col(f"removed_{n}"), F.col("tokens")), 6).alias(f"{n}_rate")
        for n in ("default", "custom")])


def _removed(tokens: str, name: str) -> Column:
    words = stopwords(name)
    return F.size(F.filter(tokens, lambda t: in_list(t, words)))


# --- vocabulary jobs -----------------------------------------------------------

# --- fixed values: irregular noun plurals and noun endings of the lemmatiser ---
NOUN_EXCEPTIONS = {
    "men": "man", "women": "woman", "children": "child", "feet": "foot", "teeth": "tooth",
    "geese": "goose", "mice": "mouse", "oxen": "ox", "wives": "wife", "lives": "life",
    "knives": "knife", "wolves": "wolf", "leaves": "leaf", "halves": "half", "data": "datum",
    "criteria": "criterion", "phenomena": "phenomenon", "analyses": "analysis", "crises": "crisis",
    "hypotheses": "hypothesis", "theses": "thesis", "bacteria": "bacterium", "media": "medium",
    "indices": "index", "matrices": "matrix", "vertices": "vertex",
}
NOUN_ENDINGS = [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
                ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y")]


def lemmas(vocab: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``term, lemma`` for a table of distinct terms.

    A candidate (irregular form, or a noun ending replaced) counts only if the
    lexicon lists it; the shortest candidate wins, else the term stays.
    Distinct terms on both sides, so the join has no hot key.
    """
    irregular = F.create_map(*[F.lit(x) for p in NOUN_EXCEPTIONS.items() for x in p])
    term = F.col("term")
    options = [F.when(term.endswith(a) & (F.char_length(term) > len(a)),
                      F.concat(F.left(term, F.char_length(term) - len(a)), F.lit(b)))
               for a, b in NOUN_ENDINGS]
    exploded = (vocab.select("term", F.explode(F.array_union(
        F.array(F.struct(F.lit(0).alias("order"), irregular[term].alias("candidate"))),
        F.transform(F.array(term, *options), lambda c: F.struct(F.lit(1).alias("order"), c.alias("candidate"))))).alias("c"))
        .select("term", "c.*").filter("candidate IS NOT NULL"))
    listed = lexicon.select(F.col("term").alias("candidate")).distinct()
    best = (exploded.join(listed, "candidate", "left_semi").groupBy("term")
            .agg(F.min(F.struct("order", F.char_length("candidate").alias("n"), "candidate")).alias("best")))
    return vocab.select("term").join(best, "term", "left").select(
        "term", F.coalesce("best.candidate", "term").alias("lemma"))

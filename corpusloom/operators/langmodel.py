"""N-gram language models with Kneser-Ney smoothing, as count tables and joins.

Words become dense numbers once; a context of two words is one 64-bit number, and
the counts of all classes stand side by side.  The trigrams of a text hold its bigrams
(their last two words), so one table of trigram counts gives both orders.

Scoring first reduces the documents to their distinct trigrams, resolves each one
once through left joins (missing statistics mean back-off), for all orders and classes
together, and only then returns to the documents.  Hot words therefore cost one row
per distinct n-gram, and the last join back to the documents has one row per key on
the model side, which AQE can split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..functions.fixed import LABELS
from ..functions.tokens import ngrams
from ..session import settle
from .lookup import replaced
from .ordered import running_sums
from .terms import attach, top_per_group

DISCOUNT = 0.75
EPS = 1e-12


def words(order: int) -> list[str]:
    return [f"w{i + 1}" for i in range(order)]


def gram_rows(docs: DataFrame, order: int, keep: Sequence[str], tokens: str = "tokens") -> DataFrame:
    return docs.select(*keep, F.explode(ngrams(F.col(tokens), order)).alias("g")).select(*keep, "g.*")


def gram_counts(docs: DataFrame, order: int, by: Sequence[str] = ("label",), tokens: str = "tokens") -> DataFrame:
    """``by, w1..wn, c``."""
    return gram_rows(docs, order, by, tokens).groupBy(*by, *words(order)).agg(F.count(F.lit(1)).alias("c"))


def context_stats(counts: DataFrame, order: int) -> DataFrame:
    """Per context: total count ``n`` and distinct followers ``followers``."""
    return counts.groupBy("label", *words(order - 1)).agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("followers"))


def top_ngrams(counts: DataFrame, order: int, n: int = 20) -> DataFrame:
    named = counts.select("label", F.concat_ws(" ", *words(order)).alias("gram"), F.col("c").alias("n"))
    return top_per_group(named, ["label"], "n", ["gram"], n)


#: Fixed numbers: words the model does not know, start and end marks; known words follow.
UNKNOWN, START, END, FIRST = 0, 1, 2, 3
_LOW = (1 << 32) - 1


@dataclass(frozen=True)
class Model:
    """One model per class, as tables that all classes share."""

    words: DataFrame  # word, id
    trigrams: DataFrame  # ctx (first word * 2^32 + second), w, c_<label>
    bigrams: DataFrame  # ctx (first word), w, c_<label>
    labels: Sequence[str]
    tokens: str = "tokens"

    def columns(self, prefix: str) -> list[str]:
        return [f"{prefix}_{c}" for c in self.labels]

    def contexts(self, order: int) -> DataFrame:
        """``ctx, n_<label>, f_<label>``: total and distinct followers of each context."""
        grams = self.trigrams if order == 3 else self.bigrams
        return grams.groupBy("ctx").agg(*[F.sum(f"c_{c}").alias(f"n_{c}") for c in self.labels],
                                        *[F.sum((F.col(f"c_{c}") > 0).cast("long")).alias(f"f_{c}") for c in self.labels])

    def preceded(self, order: int) -> DataFrame:
        """``w, b_<label>``: distinct contexts before each word."""
        grams = self.trigrams if order == 3 else self.bigrams
        return grams.groupBy("w").agg(*[F.sum((F.col(f"c_{c}") > 0).cast("long")).alias(f"b_{c}") for c in self.labels])

    def sizes(self) -> DataFrame:
        """One row: vocabulary with its end mark (``v_<label>``) and bigram types (``t_<label>``)."""
        words = self.preceded(2).agg(*[F.sum((F.col(f"b_{c}") > 0).cast("long")).alias(f"v_{c}") for c in self.labels])
        return attach(words, self.bigrams.agg(*[F.coalesce(F.sum((F.col(f"c_{c}") > 0).cast("long")), F.lit(0)).alias(f"t_{c}") for c in self.labels]))


def fit(train: DataFrame, labels: Sequence[str] = LABELS, tokens: str = "tokens", key: str = "doc_id") -> Model:
    """Counts of every class.  ``key`` tells documents apart; empty documents count nothing."""
    labels = sorted(labels)
    vocab = train.select(F.explode(tokens).alias("word")).distinct().withColumn("_one", F.lit(1))
    words = settle(running_sums(vocab, ["_one"], [F.col("word")]).select("word", (F.col("before__one") + FIRST).alias("id")))
    grams = _trigrams(_numbered(train, words, key, tokens, ["label"]), ["label"])
    counts = [F.sum((F.col("label") == c).cast("long")).alias(f"c_{c}") for c in labels]
    trigrams = settle(grams.groupBy("ctx", "w").agg(*counts))
    bigrams = settle(trigrams.groupBy(F.col("ctx").bitwiseAND(F.lit(_LOW)).alias("ctx"), "w").agg(*[F.sum(f"c_{c}").alias(f"c_{c}") for c in labels]))
    return Model(words, trigrams, bigrams, labels, tokens)


def _numbered(docs: DataFrame, words: DataFrame, key: str, tokens: str, keep: Sequence[str] = ()) -> DataFrame:
    """``key, keep, ids``: the words of each document as numbers, in order; documents without words are left out."""
    known = words.select("word", F.col("id").alias("form"))
    rows = replaced(docs.select(key, *keep, tokens).filter(F.size(tokens) > 0), tokens, lambda asked: known.join(asked, "word", "left_semi"), LongType(), UNKNOWN, key)
    listed = rows.groupBy(key, *keep).agg(F.collect_list(tokens).alias("_lists"))
    # rows of one key are one document, their words place by place
    places = F.flatten(F.transform("_lists", lambda ids: F.transform(ids, lambda x, i: F.struct(i.alias("_pos"), x.alias("id")))))
    merged = F.transform(F.array_sort(places), lambda x: x["id"])
    return listed.select(key, *keep, F.when(F.size("_lists") == 1, F.col("_lists")[0]).otherwise(merged).alias("ids"))


def _trigrams(numbered: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep, ctx, w`` of every place of the padded documents."""
    start, end = F.lit(START).cast("long"), F.lit(END).cast("long")
    padded = numbered.select(*keep, F.concat(F.array(start, start), "ids", F.array(end)).alias("p"))
    size = F.size("p") - 2
    zipped = F.arrays_zip(F.slice("p", 1, size).alias("a"), F.slice("p", 2, size).alias("b"), F.slice("p", 3, size).alias("w"))
    return padded.select(*keep, F.explode(zipped).alias("g")).select(
        *keep, (F.shiftleft("g.a", 32) + F.col("g.b")).alias("ctx"), F.col("g.w").alias("w"))


def _interpolate(c: str, lower: Column, uniform: Column) -> Column:
    n, count = F.col(f"n_{c}"), F.coalesce(F.col(f"c_{c}"), F.lit(0))
    p = F.greatest(count - DISCOUNT, F.lit(0.0)) / n + DISCOUNT * F.col(f"f_{c}") / n * lower
    return F.when(F.coalesce(n, F.lit(0)) == 0, lower).when(p > 0, p).otherwise(uniform)


def probabilities(model: Model, asked: DataFrame) -> DataFrame:
    """``ctx, w, p2_<label>, p3_<label>`` for distinct trigrams ``ctx, w``: of their last two words, and of all three.

    The lowest order is the continuation probability of the word; a bigram interpolates
    it with its discounted count, or equals it for an unseen context, and so on.
    """
    pair = F.col("ctx").bitwiseAND(F.lit(_LOW))
    pairs = asked.select(pair.alias("ctx"), "w").distinct()
    joined = attach(pairs.join(model.bigrams, ["ctx", "w"], "left").join(model.contexts(2), "ctx", "left").join(model.preceded(2), "w", "left"), model.sizes())
    # settled: what was shuffled for pairs goes before triples are
    two = settle(joined.select(F.col("ctx").alias("_pair"), F.col("w").alias("_w"), *[x for c in model.labels for x in (
        _interpolate(c, _lowest(c), _uniform(c)).alias(f"p2_{c}"), _uniform(c).alias(f"u_{c}"))]))
    three = asked.join(model.trigrams, ["ctx", "w"], "left").join(model.contexts(3), "ctx", "left")
    both = three.join(two, (pair == two["_pair"]) & (three["w"] == two["_w"]))
    return both.select("ctx", "w", *model.columns("p2"), *[_interpolate(c, F.col(f"p2_{c}"), F.col(f"u_{c}")).alias(f"p3_{c}") for c in model.labels])


def _uniform(c: str) -> Column:
    return 1.0 / F.greatest(F.col(f"v_{c}"), F.lit(1))


def _lowest(c: str) -> Column:
    return F.when(F.col(f"b_{c}") > 0, F.col(f"b_{c}") / F.col(f"t_{c}")).otherwise(_uniform(c))


def trigram_probability(model: Model, triples: DataFrame) -> DataFrame:
    """``label, w1, w2, w3, p3`` for distinct word triples under each class."""
    marks = triples.sparkSession.createDataFrame([("<s>", START), ("</s>", END)], "word string, id long")
    known = model.words.unionByName(marks)
    # a row a triple travels once with its words, not once a word
    rows = replaced(triples.select(*words(3), F.array(*words(3)).alias("_ids")), "_ids",
                    lambda asked: known.select("word", F.col("id").alias("form")).join(asked, "word", "left_semi"), LongType(), UNKNOWN)
    rows = settle(rows.select(*words(3), (F.shiftleft(F.col("_ids")[0], 32) + F.col("_ids")[1]).alias("ctx"), F.col("_ids")[2].alias("w")))
    found = rows.join(probabilities(model, rows.select("ctx", "w").distinct()), ["ctx", "w"])
    return found.select(*words(3), F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(f"p3_{c}").alias("p3")) for c in model.labels])).alias("x")).select(
        "x.label", *words(3), "x.p3")


def _long_form(scored: DataFrame, key: str, orders: Sequence[int], labels: Sequence[str]) -> DataFrame:
    return scored.select(key, F.explode(F.array(*[
        F.struct(F.lit(n).alias("n_order"), F.lit(c).alias("label"), F.col(f"x{n}_{c}").alias("perplexity")) for n in orders for c in labels])).alias("x")).select(
        key, "x.n_order", "x.label", "x.perplexity")


def perplexities(model: Model, docs: DataFrame, orders: Sequence[int] = (1, 2, 3), key: str = "doc_id") -> DataFrame:
    """``key, n_order, label, perplexity`` of every document under every class, for several orders in one pass.

    Documents without tokens have infinite perplexity.
    """
    if not set(orders) <= {1, 2, 3}:
        raise ValueError("orders 1 to 3 are supported")
    rows = settle(_trigrams(_numbered(docs, model.words, key, model.tokens), [key]).groupBy(key, "ctx", "w").agg(F.count(F.lit(1)).alias("m")))
    logs = [F.log(F.col(f"p{n}_{c}") + EPS).alias(f"l{n}_{c}") for n in (2, 3) for c in model.labels]
    found = probabilities(model, rows.select("ctx", "w").distinct()).select("ctx", "w", *logs)
    means = rows.join(found, ["ctx", "w"]).groupBy(key).agg(*[
        F.exp(-F.sum(F.col("m") * F.col(f"l{n}_{c}")) / F.sum("m")).alias(f"x{n}_{c}") for n in (2, 3) for c in model.labels])
    # with one word there is nothing to continue from: every token is equally likely
    scored = attach(means, model.sizes().select(*[F.exp(-F.log(_uniform(c) + EPS)).alias(f"x1_{c}") for c in model.labels]))
    empty = docs.filter(F.size(model.tokens) <= 0).select(key, *[F.lit(float("inf")).alias(f"x{n}_{c}") for n in (1, 2, 3) for c in model.labels])
    return _long_form(scored.unionByName(empty), key, orders, model.labels)


def perplexity(model: Model, docs: DataFrame, order: int = 3, key: str = "doc_id") -> DataFrame:
    """``key, label, perplexity`` of every document under every class."""
    return perplexities(model, docs, [order], key).drop("n_order")


def classify(scores: DataFrame, key: str = "doc_id") -> DataFrame:
    """The class of lowest perplexity; ties go to the first label."""
    return scores.groupBy(key).agg(
        F.min_by("label", F.struct("perplexity", "label")).alias("prediction"),
        F.min("perplexity").alias("perplexity"))


# --- the older model ---------------------------------------------------------------

def perplexity_v1(model: Model, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Trigram model that backs off to the uniform distribution: ``key, label, perplexity``.

    The back-off weight counts the distinct contexts *before the word*; the
    vocabulary leaves out the end mark.
    """
    before = model.preceded(3)
    sizes = before.filter(F.col("w") != END).agg(*[F.sum((F.col(f"b_{c}") > 0).cast("long")).alias(f"v_{c}") for c in model.labels])
    rows = settle(_trigrams(_numbered(docs, model.words, key, model.tokens), [key]).groupBy(key, "ctx", "w").agg(F.count(F.lit(1)).alias("m")))
    asked = rows.select("ctx", "w").distinct()
    joined = attach(asked.join(model.trigrams, ["ctx", "w"], "left").join(model.contexts(3), "ctx", "left").join(before, "w", "left"), sizes)

    def seen(c: str) -> Column:
        n, count, u = F.col(f"n_{c}"), F.coalesce(F.col(f"c_{c}"), F.lit(0)), F.coalesce(F.col(f"b_{c}"), F.lit(0))
        p = F.greatest(count - DISCOUNT, F.lit(0.0)) / n + DISCOUNT * u / n / F.greatest(F.col(f"v_{c}"), F.lit(1))
        return F.log(F.when(F.coalesce(n, F.lit(0)) == 0, _uniform(c)).otherwise(p) + EPS)

    found = joined.select("ctx", "w", *[seen(c).alias(f"l_{c}") for c in model.labels])
    means = rows.join(found, ["ctx", "w"]).groupBy(key).agg(*[F.exp(-F.sum(F.col("m") * F.col(f"l_{c}")) / F.sum("m")).alias(f"x3_{c}") for c in model.labels])
    empty = docs.filter(F.size(model.tokens) <= 0).select(key, *[F.lit(float("inf")).alias(f"x3_{c}") for c in model.labels])
    return _long_form(means.unionByName(empty), key, [3], model.labels).drop("n_order")

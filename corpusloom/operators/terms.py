"""Long-form document-term tables: ``(doc_id, term, tf)`` and its relatives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import LABELS
from ..session import spread


def count_row(df: DataFrame, name: str = "n_docs") -> DataFrame:
    """The row count as a one-row frame, so no action runs while planning."""
    return df.agg(F.count(F.lit(1)).alias(name))


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Adds the columns of a one-row aggregate to every row.

    ``one_row`` must come from an ungrouped ``agg``: it is broadcast as a
    single row, so this never multiplies rows.
    """
    return df.crossJoin(F.broadcast(one_row))


def postings(docs: DataFrame, tokens: str = "tokens", keep: Sequence[str] = (),
             placed: bool = False) -> DataFrame:
    """Term counts per document.

    Token arrays are shuffled once by document (unless ``placed`` says they
    already are); exploding, counting and every later per-document window then
    stay inside the partition.
    """
    rows = docs.select("doc_id", *keep, tokens)
    placed = rows if placed else spread(rows, "doc_id")
    return (placed.select("doc_id", *keep, F.explode(tokens).alias("term"))
            .groupBy("doc_id", *keep, "term").agg(F.count(F.lit(1)).alias("tf")))


#: Stands between the terms of a packed document; no tokeniser lets it through.
_MARK = "\x1f"


def packed(docs: DataFrame, tokens: str = "tokens", keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, keep, terms, tfs``: the postings of ``docs``, placed by document, as a row a document.

    For postings that are kept or shuffled: all terms in one string take about what the text
    takes, a row a term several times that.
    """
    listed = postings(docs, tokens, keep, placed=True).groupBy("doc_id", *keep).agg(F.collect_list(F.struct("term", "tf")).alias("_l"))
    return listed.select("doc_id", *keep, F.array_join("_l.term", _MARK).alias("terms"), F.col("_l.tf").alias("tfs"))


def unpacked(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, keep, term, tf`` of :func:`packed` rows; they stay where their document is."""
    each = F.arrays_zip(F.split("terms", _MARK).alias("term"), F.col("tfs").alias("tf"))
    return rows.select("doc_id", *keep, F.explode(each).alias("_p")).select("doc_id", *keep, "_p.term", "_p.tf")


def term_stats(post: DataFrame) -> DataFrame:
    """Corpus count and document frequency per term, in one aggregation."""
    return post.groupBy("term").agg(F.sum("tf").alias("corpus_tf"), F.count(F.lit(1)).alias("df"))


def vocabulary(post: DataFrame, max_features: int = 20000) -> DataFrame:
    """The ``max_features`` most frequent terms; ties by term.

    The limit is the feature, and it bounds every broadcast of the result.
    """
    return term_stats(post).orderBy(F.desc("corpus_tf"), "term").limit(max_features)


def indexed_vocabulary(vocab: DataFrame) -> DataFrame:
    """Adds ``idx``, the 0-based position of each term in sorted order."""
    # bounded by max_features, so one ordered window is fine
    return vocab.withColumn("idx", F.row_number().over(Window.orderBy("term")) - 1)


def bow(post: DataFrame, vocab: DataFrame) -> DataFrame:
    """Counts of vocabulary terms (the vocabulary is bounded, see above)."""
    return post.join(F.broadcast(vocab.select("term")), "term")


def sparsity(counts: DataFrame, docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """``n_docs, n_terms, nnz`` and the share of empty cells."""
    one = attach(attach(count_row(counts, "nnz"), count_row(docs)), count_row(vocab, "n_terms"))
    cells = F.col("n_docs").cast("double") * F.col("n_terms")
    return one.select("n_docs", "n_terms", "nnz", F.round(
        F.when(cells == 0, 0.0).otherwise(1.0 - F.col("nnz") / F.when(cells != 0, cells)), 6).alias("sparsity"))


def idf(vocab: DataFrame, docs: DataFrame, smooth: bool = True) -> DataFrame:
    """Adds ``idf``; every document of ``docs`` counts, also empty ones."""
    n, df = F.col("n_docs"), F.col("df")
    value = F.log((1.0 + n) / (1.0 + df)) + 1.0 if smooth else F.log(n / df) + 1.0
    return attach(vocab, count_row(docs)).withColumn("idf", value).drop("n_docs")


def tf_factor(tf: Column, sublinear: bool = False) -> Column:
    return 1.0 + F.log(tf) if sublinear else tf.cast("double")


def weigh(post: DataFrame, idfs: DataFrame, sublinear: bool = False,
          doc: str = "doc_id") -> DataFrame:
    """L2-normalised TF-IDF; terms outside the vocabulary are ignored.

    Adds ``weight`` to the rows of ``post``.  The same call weighs training
    documents, new documents and queries.
    """
    raw = post.join(F.broadcast(idfs.select("term", "idf")), "term").withColumn(
        "raw", tf_factor(F.col("tf"), sublinear) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(doc)))
    return raw.withColumn("weight", F.col("raw") / norm).drop("raw", "idf")


def weigh_packed(rows: DataFrame, idfs: DataFrame) -> DataFrame:
    """``doc_id, term, tf, weight`` as :func:`weigh` gives them, of packed rows.

    The norms join a row a document before the terms are laid out, so no row a term is shuffled.
    """
    def raw(some: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return unpacked(some, keep).join(F.broadcast(idfs.select("term", "idf")), "term").withColumn("raw", tf_factor(F.col("tf")) * F.col("idf"))

    norms = raw(rows).groupBy(F.col("doc_id").alias("_doc")).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    known = rows.join(norms, rows["doc_id"].eqNullSafe(norms["_doc"])).drop("_doc")
    return raw(known, ["norm"]).select("doc_id", "term", "tf", (F.col("raw") / F.col("norm")).alias("weight"))


def tfidf(post: DataFrame, docs: DataFrame, smooth: bool = True, sublinear: bool = False,
          max_features: int = 20000) -> DataFrame:
    """Fit and transform in one call."""
    return weigh(post, idf(vocabulary(post, max_features), docs, smooth), sublinear)


# --- rankings per class --------------------------------------------------------

def top_per_group(df: DataFrame, by: Sequence[str], score: str, tie: Sequence[str], n: int,
                  rank: str = "rank") -> DataFrame:
    """The ``n`` best rows per group.

    ``row_number() <= n`` lets Spark keep only ``n`` rows per group in each
    task before the shuffle, so a hot group never reaches one task whole.
    """
    order = Window.partitionBy(*by).orderBy(F.desc(score), *tie)
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= n)


def class_sums(values: DataFrame, value: str = "tf") -> DataFrame:
    return values.groupBy("label", "term").agg(F.sum(value).alias("total"))


def top_terms_per_class(counts: DataFrame, n: int = 30) -> DataFrame:
    return top_per_group(class_sums(counts), ["label"], "total", ["term"], n)


def class_sizes(docs: DataFrame) -> DataFrame:
    return docs.groupBy("label").agg(F.count(F.lit(1)).alias("n_docs"))


def top_tfidf_terms(weights: DataFrame, docs: DataFrame, n: int = 15) -> DataFrame:
    """Best terms by mean weight over *all* documents of the class, zeros included."""
    means = (class_sums(weights, "weight")
             .join(F.broadcast(class_sizes(docs)), "label")  # one row per label
             .select("label", "term", F.round(F.col("total") / F.col("n_docs"), 6).alias("score")))
    return top_per_group(means, ["label"], "score", ["term"], n)


def discriminative_terms(weights: DataFrame, docs: DataFrame, n: int = 15,
                         labels: Sequence[str] = LABELS) -> DataFrame:
    """Mean weight in the first class minus mean weight in the second."""
    if len(labels) != 2:
        raise ValueError("discriminative terms need exactly two classes")
    first, second = sorted(labels)

    def part(label: str) -> Column:
        return F.sum(F.when(F.col("label") == label, F.col("weight")).otherwise(0.0)).alias(f"s_{label}")

    sizes = docs.agg(*[F.sum((F.col("label") == c).cast("long")).alias(f"n_{c}") for c in (first, second)])
    sums = attach(weights.groupBy("term").agg(part(first), part(second)), sizes)
    diff = sums.select("term", F.round(
        F.col(f"s_{first}") / F.col(f"n_{first}") - F.col(f"s_{second}") / F.col(f"n_{second}"), 6).alias("diff"))
    return diff.orderBy(F.desc("diff"), "term").limit(n)

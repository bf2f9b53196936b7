"""Quality rules: plain counts of a text, and a hashed n-gram likelihood ratio.

Two multinomials over hashed word n-grams are counted: one over a trusted
target, one over the raw corpus.  A document's score is the mean over its
n-grams of ``log p(target) - log p(raw)``; documents under a fixed threshold go.
A trusted document is scored without its own counts, so it is judged as if it were not
in the target; n-grams of which the corpus has seen little say little.
Everything is built-in expressions: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, id_and_text, sealed, settle, words

#: Hash buckets of the multinomials.
BUCKETS = 1 << 16
#: N-grams drawn from the raw corpus' shares that smooth the target's (Dirichlet prior).
MASS = 65_536.0
#: Occurrences in the raw corpus at which a bucket's log ratio counts half.
LITTLE = 32.0
#: Documents whose mean log ratio is lower are not kept.
THRESHOLD = -0.2
#: Trusted documents that the target multinomial is counted over, at most.
TRUSTED = 20_000
MIN_WORDS = 50


def trusted_ids(labels: DataFrame, limit: int = TRUSTED) -> DataFrame:
    """``doc_id`` of at most ``limit`` documents labelled good, drawn by hash: the same ones each time."""
    good = labels.filter(labels["quality"] == 1).select(labels["doc_id"].alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def hashes(tokens: str) -> str:
    """SQL of a token column's hashes, one a word; windows are hashed over these."""
    return f"transform({tokens}, w -> xxhash64(w))"


def grams(hashed: str, buckets: int) -> str:
    """SQL of the buckets of single words and of pairs of neighbours, from a column of word hashes."""
    return (f"concat(transform({hashed}, h -> cast(pmod(h, {buckets}L) as int)), transform(slice({hashed}, 2, greatest(size({hashed}) - 1, 0)), "
            f"(h, i) -> cast(pmod(xxhash64({hashed}[i], h), {buckets}L) as int)))")


def _known(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    """Adds ``_trusted``; ``trusted`` is at most ``TRUSTED`` ids, so it is broadcast."""
    known = trusted.select(F.col("doc_id").alias("_known")).distinct()
    return rows.join(F.broadcast(known), F.col("doc_id") == F.col("_known"), "left").withColumn("_trusted", F.col("_known").isNotNull()).drop("_known")


def shares(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``b, raw, target, all_raw, all_target``: counts of every bucket, and their sums; the raw ones cover every document."""
    rows = _known(id_and_text(docs), trusted).select("_trusted", words(F.col("text")).alias("_w")).selectExpr("_trusted", f"{hashes('_w')} AS _h")
    counts = (rows.selectExpr(f"explode({grams('_h', buckets)}) AS b", "cast(_trusted as long) AS t")
              .groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target")))
    filled = (docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b")).join(counts, "b", "left")
              .na.fill(0, ["raw", "target"]))
    sums = filled.agg(F.sum("raw").alias("all_raw"), F.sum("target").alias("all_target"))
    return filled.crossJoin(F.broadcast(sums))  # one row


def _ratio(mass: float, buckets: int, raw: str = "raw", target: str = "target", all_raw: str = "all_raw", all_target: str = "all_target") -> str:
    """SQL of a bucket's log ratio."""
    share = f"(({raw} + 1D) / ({all_raw} + {buckets}D))"
    return f"(ln(({target} + {mass}D * {share}) / ({all_target} + {mass}D)) - ln({share})) * {raw} / ({raw} + {LITTLE}D)"


def ratios(counts: DataFrame, buckets: int = BUCKETS, mass: float = MASS) -> DataFrame:
    """One row: ``w``, by bucket the log ratio of the target's share to the raw corpus' share, and the counts and sums it comes from."""
    return (counts.selectExpr("b", f"{_ratio(mass, buckets)} AS r", "raw", "target", "all_raw", "all_target")
            .agg(F.sort_array(F.collect_list(F.struct("b", "r", "raw", "target"))).alias("c"), F.first("all_raw").alias("all_raw"), F.first("all_target").alias("all_target"))
            .selectExpr("c.r AS w", "c.raw AS raw", "c.target AS target", "all_raw", "all_target"))


def _own_score(model: str, hashed: str, buckets: int, mass: float) -> str:
    """SQL of a document's score against the target without it, from a column of its word hashes.

    Its buckets are sorted, so each one's count is known at the end of its run.
    """
    size = f"(2 * size({hashed}) - 1)"
    ratio = _ratio(mass, buckets, f"{model}.raw[a.b]", f"({model}.target[a.b] - a.n)", f"{model}.all_raw", f"({model}.all_target - {size})")
    run = f"IF(a.n = 0, 0D, a.n * {ratio})"
    return (f"aggregate(sort_array({grams(hashed, buckets)}), named_struct('b', 0, 'n', 0L, 's', 0D), "
            f"(a, x) -> IF(x = a.b, named_struct('b', a.b, 'n', a.n + 1L, 's', a.s), named_struct('b', x, 'n', 1L, 's', a.s + {run})), a -> a.s + {run}) / {size}")


def base_counts(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The plain counts of each text, next to the columns in ``keep`` (the id by default).

    ``n_repeat_words`` counts the words that lie in a window of three words found
    at least twice: where two windows have one hash, windows are sorted by hash with their
    place, neighbours of equal hash are marked, and the marked places are merged in one
    pass.  Words are hashed once; a window's hash is that of its words' hashes.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    cols = [docs[c] for c in keep or ["doc_id"]]
    names = [f"`{c}`" for c in keep or ["doc_id"]]
    out = docs.select(*cols, text.alias("_t"), words(text).alias("_w"))
    out = out.selectExpr(
        *names, f"{hashes('_w')} AS _h", "cast(size(_w) as long) AS _n_words", "cast(length(concat_ws('', _w)) as long) AS _word_chars",
        "cast(length(_t) - length(regexp_replace(_t, '[#*$%&|<>]', '')) as long) AS _n_symbols",
        f"filter(split(_t, '\\n'), x -> x rlike '[^{SPACE}]') AS _lines")
    out = out.selectExpr(
        *names, "_h", "_n_words", "_word_chars", "_n_symbols", "cast(size(_lines) - size(array_distinct(_lines)) as long) AS _n_dup_lines",
        "CASE WHEN size(_h) >= 3 THEN transform(slice(_h, 3, size(_h) - 2), (x, i) -> xxhash64(_h[i], _h[i + 1], x)) END AS _k")
    out = out.selectExpr(
        *names, "_h", "_n_words", "_word_chars", "_n_symbols", "_n_dup_lines",
        "CASE WHEN size(array_distinct(_k)) < size(_k) THEN sort_array(transform(_k, (h, i) -> struct(h AS h, i AS i))) END AS _s")
    out = out.selectExpr(
        *names, "_h", "_n_words", "_word_chars", "_n_symbols", "_n_dup_lines",
        "sort_array(transform(filter(_s, (x, j) -> x.h <=> get(_s, j - 1).h OR x.h <=> get(_s, j + 1).h), x -> x.i)) AS _p")
    covered = ("cast(coalesce(aggregate(_p, named_struct('n', 0, 'last', -1), "
               "(a, i) -> named_struct('n', a.n + i + 2 - greatest(a.last, i - 1), 'last', i + 2), a -> a.n), 0) as long)")
    return out.selectExpr(*names, "_h", "_n_words", "_word_chars", "_n_symbols", "_n_dup_lines", f"{covered} AS _n_repeat_words")


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS,
          keep: list[str] | None = None) -> DataFrame:
    """Counts, score and verdict of every document.

    ``trusted`` names the target's documents (see :func:`trusted_ids`).  Nulls are
    empty texts; a text without words scores 0 and fails the base rule.  Repeated
    rows and ids are judged each on their own; extra columns of ``docs`` are not
    read.  An empty table gives no rows.  ``keep`` lists columns of ``docs`` to
    return (``doc_id`` by default).
    """
    return _judge(docs, docs, trusted, threshold, buckets, keep or ["doc_id"])


def _judge(docs: DataFrame, corpus: DataFrame, trusted: DataFrame, threshold: float, buckets: int, keep: list[str]) -> DataFrame:
    names = [f"`{c}`" for c in keep]
    carried = names if "doc_id" in keep else [*names, "doc_id"]
    counts = settle(shares(corpus, trusted, buckets), "shares")
    model = ratios(counts, buckets).select(F.struct("*").alias("m")).scalar()
    out = _known(base_counts(docs, [c.strip("`") for c in carried]), trusted).withColumn("_m", model)
    weight = f"_m.w[cast(pmod({{}}, {buckets}L) as int)]"
    score = (f"(aggregate(transform(_h, h -> {weight.format('h')}), 0D, (a, x) -> a + x) + "
             f"aggregate(transform(slice(_h, 2, greatest(size(_h) - 1, 0)), (h, i) -> {weight.format('xxhash64(_h[i], h)')}), 0D, (a, x) -> a + x))"
             " / nullif(2 * _n_words - 1, -1)")
    out = out.selectExpr(
        *carried, "_n_words", "_word_chars", "_n_symbols", "_n_dup_lines", "_n_repeat_words",
        f"_n_words < {MIN_WORDS} OR 100 * _n_repeat_words > 50 * _n_words AS _failed",
        f"coalesce(CASE WHEN _trusted AND _n_words > 0 THEN {_own_score('_m', '_h', buckets, MASS)} ELSE {score} END, 0D) AS _llr")
    return sealed(out, *names, "_n_words AS n_words", "_word_chars AS word_chars", "_n_symbols AS n_symbols", "_n_dup_lines AS n_dup_lines",
                  "_n_repeat_words AS n_repeat_words", "_failed AS base_failed", f"NOT _failed AND _llr >= {threshold}D AS kept", "_llr AS llr")


def keep_good(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass, with the columns they came with.

    Null texts and texts without words fail the base rule and go; repeated rows are
    judged each on their own, rows without id like others.
    """
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    row = F.struct(*plain.columns).alias("row")
    carried = plain.select(row, *[plain[f"c{docs.columns.index(c)}"].alias(c) for c in ("doc_id", "text")])
    judged = _judge(carried, docs, trusted, threshold, BUCKETS, ["row"])
    return judged.filter("kept").select("row.*").toDF(*docs.columns)

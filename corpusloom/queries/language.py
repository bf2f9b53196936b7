"""N-gram and language-model queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tokens import tokenize
from ..operators import langmodel as lm
from ..operators import metrics, sampling
from ..session import settle
from . import sql
from .base import labelled, labelled_split, query, shared
from .learning import metrics_sql

_GRAM_COLS = {1: "p[i] AS w1", 2: "p[i] AS w1, p[i + 1] AS w2", 3: "p[i] AS w1, p[i + 1] AS w2, p[i + 2] AS w3"}


def grams_sql(n: int, src: str, keep: str, name: str) -> str:
    pad = "[" + ", ".join(["'<s>'"] * (n - 1)) + "]"
    return f"""{name} AS (SELECT {keep}, {_GRAM_COLS[n]} FROM (
  SELECT {keep}, p, unnest(range(1, len(p) - {n} + 2)) AS i FROM (
    SELECT {keep}, list_concat({pad}::VARCHAR[], k, ['</s>']) AS p FROM {src})))"""


TOKENS_SQL = f"""{sql.LABELLED}, {sql.SPLIT},
toks AS (SELECT c.doc_id, c.label, s.part, {sql.custom('c.clean_text')} AS k FROM corpus c JOIN parts s ON c.doc_id = s.doc_id),
train AS (SELECT * FROM toks WHERE part = 'train'), test AS (SELECT * FROM toks WHERE part = 'test')"""


def _texts(spark: SparkSession, data: str) -> DataFrame:
    """``doc_id, label, clean_text, part``; kept as texts, which take a third of what their tokens do."""
    return shared(spark, data, "lm_texts", lambda: labelled(spark, data).select("doc_id", "label", "clean_text").join(
        labelled_split(spark, data).select("doc_id", "part"), "doc_id"))


def _cut(texts: DataFrame) -> DataFrame:
    return texts.select("doc_id", "label", tokenize(F.col("clean_text"), "custom").alias("tokens"), "part")


def _part(spark: SparkSession, data: str, name: str) -> DataFrame:
    return _cut(_texts(spark, data).filter(F.col("part") == name))


def _counts_sql(n: int) -> str:
    cols = ", ".join(f"w{i + 1}" for i in range(n))
    gram = " || ' ' || ".join(f"w{i + 1}" for i in range(n))
    return f"""{grams_sql(n, 'train', 'label', f'g{n}')},
c{n} AS (SELECT label, {cols}, {gram} AS gram, count(*) AS c FROM g{n} GROUP BY label, {cols})"""


@query("ngram_counts", f"""WITH {TOKENS_SQL}, {", ".join(_counts_sql(n) for n in (1, 2, 3))}
{" UNION ALL ".join(f"SELECT {n} AS n_order, label, gram, c FROM c{n}" for n in (1, 2, 3))}""")
def ngram_counts(spark: SparkSession, data: str) -> DataFrame:
    parts = None
    for n in (1, 2, 3):
        part = lm.gram_counts(_part(spark, data, "train"), n).select(
            F.lit(n).alias("n_order"), "label", F.concat_ws(" ", *lm.words(n)).alias("gram"), "c")
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query("ngram_context_stats", f"""WITH {TOKENS_SQL}, {_counts_sql(2)}, {_counts_sql(3)}
SELECT 2 AS n_order, label, w1 AS context, sum(c)::BIGINT AS n, count(*) AS followers FROM c2 GROUP BY ALL
UNION ALL SELECT 3, label, w1 || ' ' || w2, sum(c)::BIGINT, count(*) FROM c3 GROUP BY label, w1, w2""")
def ngram_context_stats(spark: SparkSession, data: str) -> DataFrame:
    parts = None
    for n in (2, 3):
        part = lm.context_stats(lm.gram_counts(_part(spark, data, "train"), n), n).select(
            F.lit(n).alias("n_order"), "label", F.concat_ws(" ", *lm.words(n - 1)).alias("context"), "n", "followers")
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query("top_ngrams", f"""WITH {TOKENS_SQL}, {", ".join(_counts_sql(n) for n in (1, 2, 3))},
a AS ({" UNION ALL ".join(f"SELECT {n} AS n_order, label, gram, c AS n FROM c{n}" for n in (1, 2, 3))})
SELECT n_order, label, gram, n, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY n_order, label ORDER BY n DESC, gram) AS rank FROM a) WHERE rank <= 20""")
def top_ngrams(spark: SparkSession, data: str) -> DataFrame:
    parts = None
    for n in (1, 2, 3):
        part = lm.top_ngrams(lm.gram_counts(_part(spark, data, "train"), n), n).select(
            F.lit(n).alias("n_order"), "label", "gram", "n", "rank")
        parts = part if parts is None else parts.unionByName(part)
    return parts


KN_SQL = f"""{TOKENS_SQL}, {_counts_sql(2)}, {_counts_sql(3)},
classes(label) AS (VALUES ('fake'), ('real')),
x2 AS (SELECT label, w1, sum(c) AS n, count(*) AS f FROM c2 GROUP BY ALL),
x3 AS (SELECT label, w1, w2, sum(c) AS n, count(*) AS f FROM c3 GROUP BY ALL),
cont AS (SELECT label, w2, count(DISTINCT w1) AS b FROM c2 GROUP BY ALL),
size AS (SELECT label, (SELECT count(*) FROM c2 WHERE c2.label = c.label) AS types,
  (SELECT count(DISTINCT t) + 1 FROM (SELECT label, unnest(k) AS t FROM train) z WHERE z.label = c.label) AS v FROM classes c),
{grams_sql(3, 'test', 'doc_id', 'q3')}, {grams_sql(2, 'test', 'doc_id', 'q2')},
pairs AS (SELECT DISTINCT w1, w2 FROM q2 UNION SELECT DISTINCT w2, w3 FROM q3),
a2 AS (SELECT s.label, p.w1, p.w2, s.v, coalesce(c2.c, 0) AS c, coalesce(x2.n, 0) AS n, coalesce(x2.f, 0) AS f,
    CASE WHEN cont.b > 0 THEN cont.b::DOUBLE / s.types ELSE 1.0 / s.v END AS p1
  FROM pairs p CROSS JOIN size s
  LEFT JOIN c2 ON c2.label = s.label AND c2.w1 = p.w1 AND c2.w2 = p.w2
  LEFT JOIN x2 ON x2.label = s.label AND x2.w1 = p.w1
  LEFT JOIN cont ON cont.label = s.label AND cont.w2 = p.w2),
p2 AS (SELECT label, w1, w2, v, CASE WHEN n = 0 THEN p1
    WHEN greatest(c - 0.75, 0) / n + 0.75 * f / n * p1 > 0 THEN greatest(c - 0.75, 0) / n + 0.75 * f / n * p1
    ELSE 1.0 / v END AS p2 FROM a2),
triples AS (SELECT DISTINCT w1, w2, w3 FROM q3),
a3 AS (SELECT p2.label, t.w1, t.w2, t.w3, p2.v, p2.p2, coalesce(c3.c, 0) AS c, coalesce(x3.n, 0) AS n, coalesce(x3.f, 0) AS f
  FROM triples t JOIN p2 ON p2.w1 = t.w2 AND p2.w2 = t.w3
  LEFT JOIN c3 ON c3.label = p2.label AND c3.w1 = t.w1 AND c3.w2 = t.w2 AND c3.w3 = t.w3
  LEFT JOIN x3 ON x3.label = p2.label AND x3.w1 = t.w1 AND x3.w2 = t.w2),
p3 AS (SELECT label, w1, w2, w3, CASE WHEN n = 0 THEN p2
    WHEN greatest(c - 0.75, 0) / n + 0.75 * f / n * p2 > 0 THEN greatest(c - 0.75, 0) / n + 0.75 * f / n * p2
    ELSE 1.0 / v END AS p3 FROM a3),
ppl AS (
  SELECT 1 AS n_order, d.doc_id, s.label, exp(-ln(1.0 / s.v + 1e-12)) AS ppl FROM test d CROSS JOIN size s WHERE len(d.k) > 0
  UNION ALL SELECT 2, q.doc_id, p.label, exp(-avg(ln(p.p2 + 1e-12))) FROM q2 q JOIN p2 p ON p.w1 = q.w1 AND p.w2 = q.w2
    WHERE q.doc_id IN (SELECT doc_id FROM test WHERE len(k) > 0) GROUP BY ALL
  UNION ALL SELECT 3, q.doc_id, p.label, exp(-avg(ln(p.p3 + 1e-12)))
    FROM q3 q JOIN p3 p ON p.w1 = q.w1 AND p.w2 = q.w2 AND p.w3 = q.w3
    WHERE q.doc_id IN (SELECT doc_id FROM test WHERE len(k) > 0) GROUP BY ALL)"""


def _model(spark: SparkSession, data: str) -> lm.Model:
    key = (spark.sparkContext.applicationId, data)
    if key not in _models:
        _models[key] = lm.fit(_part(spark, data, "train"))  # its tables are settled
    return _models[key]


_models: dict[tuple[str, str], lm.Model] = {}


@query("kn_prob", f"WITH {KN_SQL} SELECT label, w1, w2, w3, round(p3, 8) AS p FROM p3")
def kn_prob(spark: SparkSession, data: str) -> DataFrame:
    triples = settle(lm.gram_rows(_part(spark, data, "test"), 3, []).distinct())
    return lm.trigram_probability(_model(spark, data), triples).select(
        "label", "w1", "w2", "w3", F.round("p3", 8).alias("p"))


@query("kn_perplexity", f"WITH {KN_SQL} SELECT n_order, doc_id, label, round(ppl, 3) AS perplexity FROM ppl")
def kn_perplexity(spark: SparkSession, data: str) -> DataFrame:
    found = lm.perplexities(_model(spark, data), _part(spark, data, "test"))
    return found.withColumn("perplexity", F.round("perplexity", 3))


@query("lm_classify", f"""WITH {KN_SQL},
r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY doc_id ORDER BY ppl, label) AS rn FROM ppl WHERE n_order = 3),
pred AS (SELECT r.doc_id, d.label, r.label AS prediction FROM r JOIN test d ON d.doc_id = r.doc_id WHERE rn = 1)
SELECT doc_id, label, prediction FROM pred""")
def lm_classify(spark: SparkSession, data: str) -> DataFrame:
    test = _part(spark, data, "test")
    predicted = lm.classify(lm.perplexity(_model(spark, data), test, 3))
    return test.select("doc_id", "label").join(predicted, "doc_id").select("doc_id", "label", "prediction")


@query("lm_metrics", f"""WITH {KN_SQL},
r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY doc_id ORDER BY ppl, label) AS rn FROM ppl WHERE n_order = 3),
pred AS (SELECT r.doc_id, d.label, r.label AS prediction FROM r JOIN test d ON d.doc_id = r.doc_id WHERE rn = 1),
{metrics_sql('pred')} SELECT * FROM weighted""")
def lm_metrics(spark: SparkSession, data: str) -> DataFrame:
    return metrics.evaluate(lm_classify(spark, data))


V1_SQL = f"""{sql.LABELLED},
parts AS (SELECT doc_id, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS part FROM (
  SELECT doc_id, count(*) OVER () AS n, row_number() OVER (ORDER BY md5(doc_id::VARCHAR || ':42'), doc_id) AS rn FROM corpus)),
toks AS (SELECT c.doc_id, c.label, s.part, {sql.custom('c.clean_text')} AS k FROM corpus c JOIN parts s ON c.doc_id = s.doc_id),
train AS (SELECT * FROM toks WHERE part = 'train'), test AS (SELECT * FROM toks WHERE part = 'test'),
{_counts_sql(3)}, {grams_sql(3, 'test', 'doc_id', 'q3')},
x3 AS (SELECT label, w1, w2, sum(c) AS n FROM c3 GROUP BY ALL),
u AS (SELECT label, w3, count(*) AS u FROM c3 GROUP BY ALL),
size AS (SELECT label, count(DISTINCT t) AS v FROM (SELECT label, unnest(k) AS t FROM train) GROUP BY label),
p AS (SELECT q.doc_id, s.label, CASE WHEN coalesce(x3.n, 0) = 0 THEN 1.0 / s.v
    ELSE greatest(coalesce(c3.c, 0) - 0.75, 0) / x3.n + 0.75 * coalesce(u.u, 0) / x3.n / s.v END AS p
  FROM q3 q CROSS JOIN size s
  LEFT JOIN c3 ON c3.label = s.label AND c3.w1 = q.w1 AND c3.w2 = q.w2 AND c3.w3 = q.w3
  LEFT JOIN x3 ON x3.label = s.label AND x3.w1 = q.w1 AND x3.w2 = q.w2
  LEFT JOIN u ON u.label = s.label AND u.w3 = q.w3)"""


@query("lm_v1_perplexity", f"""WITH {V1_SQL}
SELECT doc_id, label, round(exp(-avg(ln(p + 1e-12))), 2) AS perplexity FROM p
WHERE doc_id IN (SELECT doc_id FROM test WHERE len(k) > 0) GROUP BY ALL""")
def lm_v1_perplexity(spark: SparkSession, data: str) -> DataFrame:
    return _v1(spark, data)[0].withColumn("perplexity", F.round("perplexity", 2))


def _v1(spark: SparkSession, data: str) -> tuple[DataFrame, DataFrame]:
    """Perplexities of the test part of an unstratified split, and that part."""
    parts = sampling.split(labelled(spark, data).select("doc_id"), by=())
    both = settle(_texts(spark, data).drop("part").join(parts, "doc_id"))
    train, test = (_cut(both.filter(F.col("part") == p)) for p in ("train", "test"))
    return lm.perplexity_v1(lm.fit(train), test), test


@query("lm_v1_metrics", f"""WITH {V1_SQL},
ppl AS (SELECT doc_id, label, exp(-avg(ln(p + 1e-12))) AS ppl FROM p WHERE doc_id IN (SELECT doc_id FROM test WHERE len(k) > 0) GROUP BY ALL),
r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY doc_id ORDER BY ppl, label) AS rn FROM ppl),
pred AS (SELECT r.doc_id, d.label, r.label AS prediction FROM r JOIN test d ON d.doc_id = r.doc_id WHERE rn = 1),
{metrics_sql('pred')} SELECT * FROM weighted""")
def lm_v1_metrics(spark: SparkSession, data: str) -> DataFrame:
    """The older model as a classifier: each document goes to the class of lowest perplexity."""
    scores, test = _v1(spark, data)
    predicted = lm.classify(scores.filter(F.col("perplexity") != float("inf")))
    return metrics.evaluate(test.select("doc_id", "label").join(predicted, "doc_id"))

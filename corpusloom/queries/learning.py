"""Naive Bayes, evaluation and explanation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import LABELS
from ..operators import bayes, linear, metrics, terms
from ..operators.stages import CountBayes
from ..operators.vectors import apply_stages, fit_vectoriser
from ..session import settle
from . import sql
from .base import labelled, labelled_split, labelled_terms, query, shared, table

ALPHAS = (0.01, 0.1, 0.5, 1.0, 2.0, 5.0)
FEATURES = 5000

_N_TRAIN = "SELECT count(*) FROM parts WHERE part = 'train'"
BASE_SQL = f"""{sql.POSTINGS}, {sql.SPLIT},
train AS (SELECT p.* FROM post p JOIN parts s ON p.doc_id = s.doc_id WHERE s.part = 'train'),
test AS (SELECT p.* FROM post p JOIN parts s ON p.doc_id = s.doc_id WHERE s.part = 'test'),
{sql.vocab(FEATURES, 'train')},
{sql.weights(_N_TRAIN, True, False, 'train', name='wtr')},
{sql.weights(_N_TRAIN, True, False, 'test', name='wte')}"""


def nb_sql(alphas: tuple[float, ...], train: str = "wtr", test: str = "wte", value: str = "weight") -> str:
    return f"""
alphas(alpha) AS (VALUES {", ".join(f"({a}::DOUBLE)" for a in alphas)}),
classes(label) AS (VALUES ('fake'), ('real')),
s AS (SELECT c.label, v.term, coalesce(t.s, 0.0) AS s FROM classes c CROSS JOIN vocab v
  LEFT JOIN (SELECT label, term, sum({value})::DOUBLE AS s FROM {train} GROUP BY ALL) t
    ON t.label = c.label AND t.term = v.term),
tot AS (SELECT label, sum(s) AS total, count(*) AS v FROM s GROUP BY label),
theta AS (SELECT a.alpha, s.label, s.term, ln((s.s + a.alpha) / (tot.total + a.alpha * tot.v) + 1e-12) AS lp
  FROM s JOIN tot ON s.label = tot.label CROSS JOIN alphas a),
prior AS (SELECT label, ln(count(*)::DOUBLE / ({_N_TRAIN}) + 1e-12) AS lp FROM parts WHERE part = 'train' GROUP BY label),
part_score AS (SELECT w.doc_id, t.alpha, t.label, sum(w.{value} * t.lp) AS s
  FROM {test} w JOIN theta t ON w.term = t.term GROUP BY ALL),
scores AS (SELECT d.doc_id, d.label AS actual, a.alpha, p.label, p.lp + coalesce(x.s, 0.0) AS score
  FROM (SELECT doc_id, label FROM parts WHERE part = 'test') d CROSS JOIN alphas a CROSS JOIN prior p
  LEFT JOIN part_score x ON x.doc_id = d.doc_id AND x.alpha = a.alpha AND x.label = p.label),
wide AS (SELECT doc_id, actual AS label, alpha,
    max(score) FILTER (label = 'fake') AS score_fake, max(score) FILTER (label = 'real') AS score_real
  FROM scores GROUP BY ALL),
pred AS (SELECT *, CASE WHEN round(score_fake, 6) >= round(score_real, 6) THEN 'fake' ELSE 'real' END AS prediction,
    exp(score_fake - greatest(score_fake, score_real)) / (exp(score_fake - greatest(score_fake, score_real)) + exp(score_real - greatest(score_fake, score_real))) AS p_fake,
    exp(score_real - greatest(score_fake, score_real)) / (exp(score_fake - greatest(score_fake, score_real)) + exp(score_real - greatest(score_fake, score_real))) AS p_real
  FROM wide)"""


def split_frames(spark: SparkSession, data: str) -> dict[str, DataFrame]:
    parts = labelled_split(spark, data)
    docs = {p: parts.filter(F.col("part") == p).drop("part") for p in ("train", "test")}
    post = labelled_terms(spark, data)  # a row a document is joined, then its terms are laid out
    rows = {p: terms.unpacked(post.join(docs[p].select("doc_id"), "doc_id"), ["label"]) for p in docs}
    return {"train_docs": docs["train"], "test_docs": docs["test"],
            "train": rows["train"], "test": rows["test"]}


def weighted(spark: SparkSession, data: str) -> dict[str, DataFrame]:
    """Split frames with TF-IDF weights fitted on the training part."""
    f = split_frames(spark, data)
    vocab = shared(spark, data, "train_vocab", lambda: terms.idf(
        terms.vocabulary(f["train"], FEATURES), f["train_docs"]))
    return {**f, "vocab": vocab, "train": terms.weigh(f["train"], vocab),
            "test": terms.weigh(f["test"], vocab)}


def nb_scores(spark: SparkSession, data: str, alphas: tuple[float, ...] = (1.0,)) -> DataFrame:
    f = weighted(spark, data)
    model = bayes.fit(f["train"], f["vocab"], alphas)
    return bayes.probabilities(bayes.score(
        f["test_docs"], f["test"], model, f["train_docs"], alphas, keep=["label"]))


def nb_predictions(spark: SparkSession, data: str) -> DataFrame:
    """Test predictions at alpha 1, kept because every evaluation reads them."""
    return shared(spark, data, "nb_predictions", lambda: nb_scores(spark, data))


@query("nb_fit", f"""WITH {BASE_SQL}, {nb_sql((1.0,))}
SELECT term, round(max(lp) FILTER (label = 'fake'), 6) AS lp_fake, round(max(lp) FILTER (label = 'real'), 6) AS lp_real
FROM theta GROUP BY term""")
def nb_fit(spark: SparkSession, data: str) -> DataFrame:
    f = weighted(spark, data)
    return bayes.fit(f["train"], f["vocab"]).select(
        "term", F.round("lp_0_fake", 6).alias("lp_fake"), F.round("lp_0_real", 6).alias("lp_real"))


@query("nb_predict", f"""WITH {BASE_SQL}, {nb_sql((1.0,))}
SELECT doc_id, label, prediction, round(score_fake, 6) AS score_fake, round(score_real, 6) AS score_real FROM pred""")
def nb_predict(spark: SparkSession, data: str) -> DataFrame:
    return nb_predictions(spark, data).select(
        "doc_id", "label", "prediction", F.round("score_fake", 6).alias("score_fake"),
        F.round("score_real", 6).alias("score_real"))


@query("nb_proba", f"""WITH {BASE_SQL}, {nb_sql((1.0,))}
SELECT doc_id, prediction, round(greatest(p_fake, p_real), 6) AS confidence,
  round(p_fake, 6) AS p_fake, round(p_real, 6) AS p_real FROM pred""")
def nb_proba(spark: SparkSession, data: str) -> DataFrame:
    return nb_predictions(spark, data).select(
        "doc_id", "prediction", F.round(F.greatest("p_fake", "p_real"), 6).alias("confidence"),
        F.round("p_fake", 6).alias("p_fake"), F.round("p_real", 6).alias("p_real"))


def metrics_sql(src: str, by: str = "") -> str:
    """Weighted metrics of a ``label, prediction`` relation (two classes)."""
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    on = f"WHERE c.{by} IS NOT DISTINCT FROM o.{by}" if by else ""
    return f"""per AS (SELECT {keys}label, support, claimed, hits,
    CASE WHEN claimed = 0 THEN 0.0 ELSE hits::DOUBLE / claimed END AS p,
    CASE WHEN support = 0 THEN 0.0 ELSE hits::DOUBLE / support END AS r
  FROM (SELECT {keys}c.label, count(*) FILTER (o.label = c.label) AS support,
      count(*) FILTER (o.prediction = c.label) AS claimed,
      count(*) FILTER (o.label = c.label AND o.prediction = c.label) AS hits
    FROM {src} o CROSS JOIN (VALUES ('fake'), ('real')) c(label) GROUP BY {keys}c.label)),
per_f AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM per),
weighted AS (SELECT {keys}round(sum(hits)::DOUBLE / sum(support), 6) AS accuracy,
  round(sum(p * support) / sum(support), 6) AS precision, round(sum(r * support) / sum(support), 6) AS recall,
  round(sum(f * support) / sum(support), 6) AS f1, sum(support)::BIGINT AS support FROM per_f {group})"""


@query("nb_alpha_sweep", f"""WITH {BASE_SQL}, {nb_sql(ALPHAS)}, {metrics_sql('pred', 'alpha')}
SELECT *, row_number() OVER (ORDER BY f1 DESC, alpha) = 1 AS best FROM weighted""")
def nb_alpha_sweep(spark: SparkSession, data: str) -> DataFrame:
    table = settle(metrics.evaluate(nb_scores(spark, data, ALPHAS), by=["alpha"]))  # a row a smoothing; read twice
    best = table.agg(F.max_by("alpha", F.struct("f1", -F.col("alpha"))).alias("best_alpha"))
    return terms.attach(table, best).withColumn("best", F.col("alpha") == F.col("best_alpha")).drop("best_alpha")


@query("best_config", f"""WITH {BASE_SQL}, {nb_sql(ALPHAS)}, {metrics_sql('pred', 'alpha')}
SELECT alpha, f1 FROM weighted ORDER BY f1 DESC, alpha LIMIT 1""")
def best_config(spark: SparkSession, data: str) -> DataFrame:
    table = metrics.evaluate(nb_scores(spark, data, ALPHAS), by=["alpha"])
    return table.agg(F.max_by(F.struct("alpha", "f1"), F.struct("f1", -F.col("alpha"))).alias("b")).select("b.*")


PRED_SQL = f"{BASE_SQL}, {nb_sql((1.0,))}"


@query("eval_weighted_metrics", f"WITH {PRED_SQL}, {metrics_sql('pred')} SELECT * FROM weighted")
def eval_weighted_metrics(spark: SparkSession, data: str) -> DataFrame:
    return metrics.evaluate(nb_predictions(spark, data))


@query("eval_class_report", f"""WITH {PRED_SQL}, {metrics_sql('pred')},
t AS (SELECT sum(support)::BIGINT AS n, sum(hits)::DOUBLE / sum(support) AS acc FROM per_f)
SELECT label AS row, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support::BIGINT AS support FROM per_f
UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), n FROM t
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(support)::BIGINT FROM per_f
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), sum(support)::BIGINT FROM per_f""")
def eval_class_report(spark: SparkSession, data: str) -> DataFrame:
    return metrics.full_report(nb_predictions(spark, data))


@query("eval_confusion", f"""WITH {PRED_SQL}
SELECT a.l AS label, b.l AS prediction, (SELECT count(*) FROM pred p WHERE p.label = a.l AND p.prediction = b.l) AS n
FROM (VALUES ('fake'), ('real')) a(l) CROSS JOIN (VALUES ('fake'), ('real')) b(l)""")
def eval_confusion(spark: SparkSession, data: str) -> DataFrame:
    return metrics.confusion(nb_predictions(spark, data))


ROC_SQL = """steps AS (SELECT round(p_real, 6) AS threshold, count(*) FILTER (label = 'real') AS pos,
  count(*) FILTER (label <> 'real') AS neg FROM pred GROUP BY 1),
roc AS (SELECT threshold,
  sum(neg) OVER (ORDER BY threshold DESC)::DOUBLE / sum(neg) OVER () AS fpr,
  sum(pos) OVER (ORDER BY threshold DESC)::DOUBLE / sum(pos) OVER () AS tpr FROM steps)"""


def _scored(spark: SparkSession, data: str) -> DataFrame:
    """Engines add up log-probabilities in different orders: scores compared here have 6 digits."""
    return nb_predictions(spark, data).withColumn("score", F.round("p_real", 6))


@query("eval_roc", f"""WITH {PRED_SQL}, {ROC_SQL}
SELECT threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM roc""")
def eval_roc(spark: SparkSession, data: str) -> DataFrame:
    return metrics.roc_points(_scored(spark, data)).select(
        "threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query("eval_auc", f"""WITH {PRED_SQL},
p AS (SELECT round(p_real, 6) AS s, label FROM pred)
SELECT round(sum(CASE WHEN a.s > b.s THEN 1.0 WHEN a.s = b.s THEN 0.5 ELSE 0.0 END)::DOUBLE / count(*), 6) AS auc
FROM p a JOIN p b ON a.label = 'real' AND b.label = 'fake'""")
def eval_auc(spark: SparkSession, data: str) -> DataFrame:
    return metrics.auc(metrics.roc_points(_scored(spark, data))).withColumn("auc", F.round("auc", 6))


#: Line items as cases: returned ones are the positive class, the price of a unit the score, each line status on its own.
CASES_SQL = """cases AS (SELECT l_linestatus AS status, l_returnflag = 'R' AS hit,
  l_extendedprice * (1.0 - l_discount) / l_quantity AS score FROM lineitem)"""


def _cases(spark: SparkSession, data: str) -> DataFrame:
    return table(spark, data, "lineitem").select(
        F.col("l_linestatus").alias("status"), F.when(F.col("l_returnflag") == "R", "real").otherwise("fake").alias("label"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")) / F.col("l_quantity")).alias("score"))


@query("roc_full_scores", f"""WITH {CASES_SQL},
steps AS (SELECT status, score, count(*) FILTER (hit) AS pos, count(*) FILTER (NOT hit) AS neg FROM cases GROUP BY ALL)
SELECT status, score AS threshold, pos, neg,
  CASE WHEN sum(neg) OVER w = 0 THEN 0.0 ELSE sum(neg) OVER (w ORDER BY score DESC)::DOUBLE / (sum(neg) OVER w)::DOUBLE END AS fpr,
  CASE WHEN sum(pos) OVER w = 0 THEN 0.0 ELSE sum(pos) OVER (w ORDER BY score DESC)::DOUBLE / (sum(pos) OVER w)::DOUBLE END AS tpr
FROM steps WINDOW w AS (PARTITION BY status)""")
def roc_full_scores(spark: SparkSession, data: str) -> DataFrame:
    """Unrounded scores, as many thresholds as there are."""
    return metrics.roc_points(_cases(spark, data), by=["status"]).select("status", "threshold", "pos", "neg", "fpr", "tpr")


@query("auc_full_scores", f"""WITH {CASES_SQL},
ranked AS (SELECT status, hit, 2 * rank() OVER (w ORDER BY score) + count(*) OVER (PARTITION BY status, score) - 1 AS twice
  FROM cases WINDOW w AS (PARTITION BY status)),
sums AS (SELECT status, count(*) FILTER (hit) AS p, count(*) FILTER (NOT hit) AS n, coalesce(sum(twice) FILTER (hit), 0) AS s FROM ranked GROUP BY status)
SELECT status, CASE WHEN p * n = 0 THEN 0.0 ELSE (s - p * (p + 1))::DOUBLE / (2.0 * p * n) END AS auc FROM sums""")
def auc_full_scores(spark: SparkSession, data: str) -> DataFrame:
    return metrics.auc(metrics.roc_points(_cases(spark, data), by=["status"]), ["status"])


BEST_SQL = f"""{BASE_SQL}, {nb_sql(ALPHAS)}, {metrics_sql('pred', 'alpha')},
best AS (SELECT * FROM pred WHERE alpha = (SELECT alpha FROM weighted ORDER BY f1 DESC, alpha LIMIT 1))"""


def nb_best(spark: SparkSession, data: str) -> DataFrame:
    """Test predictions at the smoothing with the best F1 (the smallest of equals)."""
    scores = shared(spark, data, "nb_sweep", lambda: nb_scores(spark, data, ALPHAS))
    table = metrics.evaluate(scores, by=["alpha"])
    best = table.agg(F.max_by("alpha", F.struct("f1", -F.col("alpha"))).alias("_best"))
    return terms.attach(scores, best).filter(F.col("alpha") == F.col("_best")).drop("_best")


@query("eval_errors", f"""WITH {BEST_SQL},
bad AS (SELECT *, row_number() OVER (ORDER BY md5(doc_id::VARCHAR || ':42'), doc_id) AS rn FROM best WHERE label <> prediction),
t AS (SELECT (SELECT count(*) FROM best) AS evaluated, count(*) AS wrong,
  count(*) FILTER (label = 'real') AS false_positive, count(*) FILTER (rn <= 30) AS sampled,
  count(*) FILTER (rn <= 30 AND label = 'real') AS sampled_false_positive FROM bad)
SELECT evaluated, wrong, round(wrong::DOUBLE / evaluated, 6) AS rate, false_positive,
  wrong - false_positive AS false_negative, sampled, sampled_false_positive,
  sampled - sampled_false_positive AS sampled_false_negative FROM t""")
def eval_errors(spark: SparkSession, data: str) -> DataFrame:
    """Errors of the model with the best smoothing."""
    return metrics.error_summary(nb_best(spark, data))


@query("nb_pipeline", f"""WITH {PRED_SQL}
SELECT doc_id, label, CASE WHEN p_real > p_fake THEN 'real' ELSE 'fake' END AS prediction, round(p_real, 6) AS p_real FROM pred""")
def nb_pipeline(spark: SparkSession, data: str) -> DataFrame:
    """The same classifier as a saved stage: vectoriser, Bayes model, row by row."""
    docs = labelled(spark, data).select("doc_id", "tokens").join(labelled_split(spark, data), "doc_id")
    train, test = (docs.filter(F.col("part") == p) for p in ("train", "test"))
    vectors, names = fit_vectoriser(split_frames(spark, data)["train"], train, FEATURES)
    rows = {p: apply_stages(d, vectors, ["doc_id", "label", "features"]) for p, d in (("train", train), ("test", test))}
    model = CountBayes(smoothing=1.0, size=len(names)).fit(rows["train"])
    return linear.predict(model, rows["test"], ["doc_id", "label"]).select("doc_id", "label", "prediction", F.round("score", 6).alias("p_real"))


@query("explain_contributions", f"""WITH {PRED_SQL},
odds AS (SELECT term, max(lp) FILTER (label = 'real') - max(lp) FILTER (label = 'fake') AS coef FROM theta GROUP BY term),
c AS (SELECT w.doc_id, w.term AS feature,
    round(w.weight * o.coef * CASE WHEN p.prediction = 'real' THEN 1 ELSE -1 END, 6) AS contribution
  FROM wte w JOIN odds o ON w.term = o.term JOIN pred p ON p.doc_id = w.doc_id)
SELECT doc_id, feature, contribution, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY abs(contribution) DESC, feature) AS rank FROM c)
WHERE rank <= 10""")
def explain_contributions(spark: SparkSession, data: str) -> DataFrame:
    f = weighted(spark, data)
    model = bayes.fit(f["train"], f["vocab"])
    return bayes.explain(f["test"], model, nb_predictions(spark, data))


@query("class_weights", f"""WITH {sql.LABELLED}, {sql.SPLIT},
t AS (SELECT label, count(*) AS n_docs FROM parts WHERE part = 'train' GROUP BY label)
SELECT label, n_docs, round((SELECT sum(n_docs) FROM t) / ((SELECT count(*) FROM t) * n_docs::DOUBLE), 6) AS weight FROM t""")
def class_weights(spark: SparkSession, data: str) -> DataFrame:
    from ..operators.linear import balanced_weights

    train = labelled_split(spark, data).filter(F.col("part") == "train")
    return balanced_weights(train).withColumn("weight", F.round("weight", 6))

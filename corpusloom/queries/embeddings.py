"""Word-vector, linear-model and experiment queries (no SQL where training is iterative)."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.fixed import KEY_TERMS, SIMILARITY_PAIRS
from ..functions.tokens import remove_stopwords, tokenize
from ..operators import embed, linear, metrics, projection, registry, sampling, terms
from ..operators import langmodel as lm
from ..operators.corpus import combine
from ..operators.vectors import apply_stages, fit_vectoriser, sparse_vector
from ..plans import experiments as ex
from ..plans.config import FEATURE_GROUP, MODEL_GROUP, PREPROCESSING_GROUP, Setup, Tokens
from ..session import beside, settle
from . import sql
from .base import labelled, labelled_postings, labelled_split, query, shared, table
from .learning import nb_best
from .language import lm_classify

DIM = 200

# --- fixture vectors ---------------------------------------------------------------


@query("mean_vectors", """SELECT label, (i - 1)::INTEGER AS dim, round(avg(embedding[i]::DOUBLE), 6) AS mean
FROM embeddings, range(1, 65) t(i) GROUP BY label, i""")
def mean_vectors(spark: SparkSession, data: str) -> DataFrame:
    return embed.mean_by_group(table(spark, data, "embeddings"), "label").select(
        "label", "dim", F.round("mean", 6).alias("mean"))


@query("vector_neighbours", """WITH d AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT vec_id, e, greatest(sqrt(list_dot_product(e, e)), 1e-9) AS n FROM d),
asked AS (SELECT min(vec_id) AS vec_id FROM embeddings GROUP BY label),
s AS (SELECT q.vec_id AS query, u.vec_id, round(list_dot_product(q.e, u.e) / (q.n * u.n), 6) AS similarity
  FROM u q JOIN asked a ON a.vec_id = q.vec_id JOIN u ON u.vec_id <> q.vec_id)
SELECT query, vec_id, similarity, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, vec_id) AS rank FROM s) WHERE rank <= 5""")
def vector_neighbours(spark: SparkSession, data: str) -> DataFrame:
    vectors = table(spark, data, "embeddings")
    asked = vectors.groupBy("label").agg(F.min("vec_id").alias("vec_id"))
    return embed.neighbours(vectors.withColumnRenamed("embedding", "vector"), asked, 5, "vec_id")


@query("poly_expand", """WITH p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings)
SELECT vec_id, round(x, 6) AS x, round(y, 6) AS y, round(x * x, 6) AS xx, round(x * y, 6) AS xy, round(y * y, 6) AS yy,
  round(x * x * x, 6) AS xxx, round(x * x * y, 6) AS xxy, round(x * y * y, 6) AS xyy, round(y * y * y, 6) AS yyy FROM p""")
def poly_expand(spark: SparkSession, data: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    xy = table(spark, data, "embeddings").select("vec_id", F.transform(
        F.slice("embedding", 1, 2), lambda v: v.cast("double")).alias("xy"))
    wide = projection.expand(xy, 3).select("vec_id", vector_to_array("features").alias("f"))
    # order of PolynomialExpansion: x, xx, xxx, y, xy, xxy, yy, xyy, yyy
    names = ["x", "xx", "xxx", "y", "xy", "xxy", "yy", "xyy", "yyy"]
    return wide.select("vec_id", *[F.round(F.col("f")[i], 6).alias(n) for i, n in enumerate(names)])


#: Two leading directions of a covariance: repeated squaring leaves the projector on the first, which is then taken out.
_PCA_SQL = """e AS (SELECT vec_id, list_slice(embedding, 1, 8)::DOUBLE[] AS v FROM embeddings),
i(i) AS (SELECT unnest(range(1, 9))),
mean AS (SELECT list(a ORDER BY i) AS m FROM (SELECT i, avg(v[i]) AS a FROM e, i GROUP BY i)),
x AS (SELECT vec_id, list_transform(range(1, 9), lambda k: v[k] - m[k]) AS x FROM e, mean),
cells AS (SELECT a.i AS r, b.i AS c, sum(x[a.i] * x[b.i]) / (count(*) - 1) AS s FROM x, i a, i b GROUP BY a.i, b.i),
cov AS (SELECT list(row ORDER BY r) AS c FROM (SELECT r, list(s ORDER BY c) AS row FROM cells GROUP BY r)),
trace AS (SELECT sum(s) AS t FROM cells WHERE r = c)"""


def _direction_sql(matrix: str, name: str) -> str:
    return f"""{name}_p(k, m) AS (SELECT 0, c FROM {matrix} UNION ALL
  SELECT k + 1, list_transform(m, lambda a: list_transform(m, lambda b: list_dot_product(a, b) / list_sum(list_transform(m, lambda d: list_dot_product(d, d)))))
  FROM {name}_p WHERE k < 30),
{name}_c AS (SELECT list_transform(range(1, 9), lambda j: m[1 + list_position(list_transform(m, lambda d: list_dot_product(d, d)),
    list_max(list_transform(m, lambda d: list_dot_product(d, d)))) - 1][j]) AS u FROM {name}_p WHERE k = 30),
{name}_u AS (SELECT list_transform(u, lambda z: z / sqrt(list_dot_product(u, u))) AS u FROM {name}_c),
{name} AS (SELECT list_transform(u, lambda z: z * CASE WHEN list_max(u) >= -list_min(u) THEN 1 ELSE -1 END) AS u,
  list_dot_product(u, list_transform(c, lambda a: list_dot_product(a, u))) AS value FROM {name}_u, {matrix})"""


@query("pca_embeddings", f"""WITH RECURSIVE {_PCA_SQL}, {_direction_sql('cov', 'one')},
rest AS (SELECT list_transform(range(1, 9), lambda a: list_transform(range(1, 9), lambda b: c[a][b] - value * u[a] * u[b])) AS c FROM cov, one),
{_direction_sql('rest', 'two')}
SELECT vec_id, round(list_dot_product(x, one.u), 5) AS x, round(list_dot_product(x, two.u), 5) AS y,
  round(one.value / t, 6) AS share_x, round(two.value / t, 6) AS share_y FROM x, one, two, trace""")
def pca_embeddings(spark: SparkSession, data: str) -> DataFrame:
    """Leading directions of the first eight numbers of each vector."""
    rows = table(spark, data, "embeddings").select("vec_id", sparse_vector(
        F.lit(8), F.sequence(F.lit(0), F.lit(7)), F.transform(F.slice("embedding", 1, 8), lambda v: v.cast("double"))).alias("features"))
    pca = projection.fit_pca(rows, 8)
    one, two = pca.explained_variance_ratio
    return pca.project(rows, ["vec_id"]).select("vec_id", F.round(F.col("xy")[0], 5).alias("x"), F.round(F.col("xy")[1], 5).alias("y"),
                                                F.lit(round(one, 6)).alias("share_x"), F.lit(round(two, 6)).alias("share_y"))


# --- the embeddings as vectors of the most frequent words -----------------------------

_WORDS_SQL = f"""{sql.POSTINGS},
ranked AS (SELECT term, row_number() OVER (ORDER BY sum(tf) DESC, term) - 1 AS n FROM post GROUP BY term),
vectors AS (SELECT r.term AS word, e.embedding::DOUBLE[] AS v FROM ranked r JOIN embeddings e ON e.vec_id = r.n)"""


def _word_table(spark: SparkSession, data: str) -> DataFrame:
    """``word, vector``: the vector whose id is the word's rank by frequency (from 0)."""
    vectors = table(spark, data, "embeddings").select(F.col("vec_id").alias("n"), F.transform("embedding", lambda v: v.cast("double")).alias("vector"))
    # as many words as there are vectors, so the ordered window is over that many rows
    words = terms.vocabulary(labelled_postings(spark, data), vectors.count())
    ranked = words.withColumn("n", F.row_number().over(Window.orderBy(F.desc("corpus_tf"), "term")) - 1)
    return ranked.join(vectors, "n").select(F.col("term").alias("word"), "vector")


_DOC_VECTORS_SQL = """sums AS (SELECT p.doc_id, i AS dim, sum(p.tf * v[i]) / sum(p.tf) AS value
  FROM post p JOIN vectors w ON w.word = p.term, range(1, 65) t(i) GROUP BY ALL)"""


@query("doc_vectors_given", f"""WITH {_WORDS_SQL}, {_DOC_VECTORS_SQL}
SELECT c.doc_id, (i - 1)::INTEGER AS dim, round(coalesce(value, 0.0), 6) AS value
FROM corpus c CROSS JOIN range(1, 65) t(i) LEFT JOIN sums s ON s.doc_id = c.doc_id AND s.dim = i""")
def doc_vectors_given(spark: SparkSession, data: str) -> DataFrame:
    found = embed.document_vectors(labelled(spark, data).select("doc_id", "tokens"), _word_table(spark, data), 64)
    return found.select("doc_id", F.posexplode("vector").alias("dim", "value")).withColumn("value", F.round("value", 6))


@query("word_similarity_given", f"""WITH {_WORDS_SQL},
u AS (SELECT word, list_transform(v, lambda z: z / greatest(sqrt(list_dot_product(v, v)), 1e-9)) AS v FROM vectors),
s AS (SELECT a.word AS query, b.word, round(list_dot_product(a.v, b.v), 6) AS similarity FROM u a JOIN u b ON a.word <> b.word)
SELECT query, word, similarity, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, word) AS rank FROM s) WHERE rank <= 5""")
def word_similarity_given(spark: SparkSession, data: str) -> DataFrame:
    """Five nearest words of every word."""
    vectors = shared(spark, data, "word_table", lambda: _word_table(spark, data))
    return embed.neighbours(vectors, vectors.select("word"), 5)


@query("feature_concat_given", f"""WITH {_WORDS_SQL}, {_DOC_VECTORS_SQL}, {sql.vocab(200)},
{sql.weights('SELECT count(*) FROM corpus', True, False)},
idx AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS i FROM vocab)
SELECT doc_id, i::INTEGER AS idx, round(weight, 6) AS value FROM w JOIN idx ON idx.term = w.term WHERE round(weight, 6) <> 0
UNION ALL SELECT doc_id, (199 + dim)::INTEGER, round(value, 6) FROM sums WHERE round(value, 6) <> 0""")
def feature_concat_given(spark: SparkSession, data: str) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    docs, post = labelled(spark, data).select("doc_id", "tokens"), labelled_postings(spark, data)
    stages, _ = fit_vectoriser(post, docs, 200)
    vectors = embed.document_vectors(docs, _word_table(spark, data), 64).select("doc_id", array_to_vector("vector").alias("means"))
    both = VectorAssembler(inputCols=["features", "means"], outputCol="both").transform(
        apply_stages(docs, stages, ["doc_id", "features"]).join(vectors, "doc_id"))
    return (both.select("doc_id", F.posexplode(vector_to_array("both")).alias("idx", "value"))
            .withColumn("value", F.round("value", 6)).filter("value <> 0"))


# --- trained word vectors --------------------------------------------------------------


def _custom_tokens(spark: SparkSession, data: str) -> DataFrame:
    return shared(spark, data, "custom_tokens", lambda: labelled(spark, data).select(
        "doc_id", "label", tokenize(F.col("clean_text"), "custom").alias("tokens")))


def _skip_gram(spark: SparkSession, data: str) -> DataFrame:
    return shared(spark, data, "skip_gram", lambda: embed.skip_gram(_custom_tokens(spark, data), DIM))


@query("word2vec_skipgram")
def word2vec_skipgram(spark: SparkSession, data: str) -> DataFrame:
    return _skip_gram(spark, data)


@query("word2vec_cbow")
def word2vec_cbow(spark: SparkSession, data: str) -> DataFrame:
    return embed.cbow(_custom_tokens(spark, data), DIM)


@query("doc_vectors")
def doc_vectors(spark: SparkSession, data: str) -> DataFrame:
    return embed.document_vectors(_custom_tokens(spark, data), _skip_gram(spark, data), DIM)


@query("word_similarity")
def word_similarity(spark: SparkSession, data: str) -> DataFrame:
    """Fixed pairs and terms, plus the corpus' own ten most frequent words."""
    vectors = _skip_gram(spark, data)
    frequent = terms.vocabulary(labelled_postings(spark, data), 10).select(F.col("term").alias("word"))
    asked = frequent.union(spark.createDataFrame([(t,) for t in KEY_TERMS], "word string"))
    near = embed.neighbours(vectors, asked, 5).select(
        F.col("query").alias("word_a"), F.col("word").alias("word_b"), "similarity", "rank")
    pairs = embed.pair_similarity(vectors, SIMILARITY_PAIRS).withColumn("rank", F.lit(0))
    return near.unionByName(pairs)


# --- linear models -----------------------------------------------------------------------


def _split_docs(spark: SparkSession, data: str) -> DataFrame:
    return labelled(spark, data).select("doc_id", "label", "source", "clean_text", "tokens").join(
        labelled_split(spark, data).select("doc_id", "part"), "doc_id")


def _features(spark: SparkSession, data: str, kind: str = "tfidf", limit: int = 5000):
    docs = _split_docs(spark, data)
    train = docs.filter(F.col("part") == "train")
    post = labelled_postings(spark, data).join(train.select("doc_id"), "doc_id")
    stages, names = fit_vectoriser(post, train, limit, kind)
    rows = shared(spark, data, f"features_{kind}_{limit}", lambda: apply_stages(
        docs, stages, ["doc_id", "label", "part", "features"]))
    return rows, names


def _sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.filter(F.col("part") == "train"), rows.filter(F.col("part") == "test")


def _evaluated(rows: DataFrame, name: str, penalty: str = "l2", balanced: bool = False) -> DataFrame:
    train, test = _sides(rows)
    model = linear.fit_logistic(train, penalty, balanced)
    return metrics.evaluate(linear.predict(model, test, ["doc_id", "label"])).select(F.lit(name).alias("name"), "*")


#: Fixed value: terms of the features that are evaluated on their own.
WIDE = 20000


def _drawn(spark: SparkSession, data: str) -> DataFrame:
    """``doc_id, part`` of a random split that doesn't look at the labels."""
    return shared(spark, data, "drawn_split", lambda: sampling.split(labelled(spark, data).select("doc_id"), by=()))


def _wide_features(spark: SparkSession, data: str, kind: str = "tfidf", stopwords: str = "none") -> DataFrame:
    """``doc_id, label, part, features`` over all documents' terms, split at random."""
    def build() -> DataFrame:
        docs = labelled(spark, data).select("doc_id", "label", remove_stopwords(F.col("tokens"), stopwords).alias("tokens"))
        post = labelled_postings(spark, data) if stopwords == "none" else terms.postings(docs)
        stages, _ = fit_vectoriser(post, docs, WIDE, kind)
        return apply_stages(docs.join(_drawn(spark, data).select("doc_id", "part"), "doc_id"), stages, ["doc_id", "label", "part", "features"])

    return shared(spark, data, f"wide_{kind}_{stopwords}", build)


@query("lr_eval")
def lr_eval(spark: SparkSession, data: str) -> DataFrame:
    return _evaluated(_wide_features(spark, data), "tfidf")


@query("lr_bow")
def lr_bow(spark: SparkSession, data: str) -> DataFrame:
    return _evaluated(_wide_features(spark, data, "bow"), "bow")


@query("lr_variants")
def lr_variants(spark: SparkSession, data: str) -> DataFrame:
    rows, _ = _features(spark, data)
    return combine(beside(lambda p: _evaluated(rows, p, p, True), ("l1", "l2", "elasticnet")))


@query("lr_top_features")
def lr_top_features(spark: SparkSession, data: str) -> DataFrame:
    rows, names = _features(spark, data)
    parts = []
    for p in ("l1", "l2", "elasticnet"):
        model = linear.fit_logistic(_sides(rows)[0], p, True)
        top = linear.top_features(linear.coefficients(spark, model, names), 20)
        parts.append(top.select(F.lit(p).alias("penalty"), "feature", F.round("coef", 6).alias("coef")))
    return combine(parts)


@query("score_batch")
def score_batch(spark: SparkSession, data: str) -> DataFrame:
    rows, _ = _features(spark, data)
    train, test = _sides(rows)
    return linear.predict(linear.fit_logistic(train, "l2", True), test, ["doc_id", "label"]).drop("score")


def _with_word_vectors(spark: SparkSession, data: str) -> DataFrame:
    rows = _wide_features(spark, data)
    vectors = shared(spark, data, "doc_vectors", lambda: doc_vectors(spark, data))
    return rows.join(vectors.select("doc_id", array_to_vector("vector").alias("w2v")), "doc_id")


@query("feature_concat")
def feature_concat(spark: SparkSession, data: str) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=["features", "w2v"], outputCol="both").transform(
        _with_word_vectors(spark, data)).select("doc_id", "label", F.col("both").cast("string").alias("vector"))


@query("feature_combinations")
def feature_combinations(spark: SparkSession, data: str) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    rows = settle(VectorAssembler(inputCols=["features", "w2v"], outputCol="both").transform(
        _with_word_vectors(spark, data)))
    parts = []
    for name, column in (("tfidf_only", "features"), ("word2vec_only", "w2v"), ("concatenated", "both")):
        parts.append(_evaluated(rows.select("doc_id", "label", "part", F.col(column).alias("features")), name))
    return combine(parts)


@query("pca_2d")
def pca_2d(spark: SparkSession, data: str) -> DataFrame:
    rows, names = _features(spark, data)
    pca = projection.fit_pca(_sides(rows)[0], len(names))
    share = pca.explained_variance_ratio
    return pca.project(rows, ["doc_id", "label", "part"]).select(
        "doc_id", "label", "part", F.round(F.col("xy")[0], 6).alias("x"), F.round(F.col("xy")[1], 6).alias("y"),
        F.lit(round(share[0], 6)).alias("share_x"), F.lit(round(share[1], 6)).alias("share_y"))


@query("poly_lr")
def poly_lr(spark: SparkSession, data: str) -> DataFrame:
    rows, names = _features(spark, data)
    pca = projection.fit_pca(_sides(rows)[0], len(names))
    flat = settle(pca.project(rows, ["doc_id", "label", "part"]))

    def row(degree: int, n_features: int) -> DataFrame:
        train, test = _sides(projection.expand(flat, degree))
        model = linear.fit_logistic(train)
        on = {name: metrics.evaluate(linear.predict(model, side, ["doc_id", "label"]))
              for name, side in (("train", train), ("test", test))}
        return terms.attach(on["test"].select("accuracy", "f1"), on["train"].select(
            F.col("accuracy").alias("train_accuracy"))).select(
            F.lit(degree).alias("degree"), F.lit(n_features).alias("features"), "train_accuracy",
            F.col("accuracy").alias("test_accuracy"), "f1",
            F.lit(projection.full_space_size(len(names))).alias("full_space"))

    return combine(beside(lambda d: row(*d), ((1, 2), (2, 5), (3, 9))))


# --- experiments ----------------------------------------------------------------------------


def _corpus(spark: SparkSession, data: str) -> ex.Corpus:
    key = (spark.sparkContext.applicationId, data)
    if key not in _corpora:
        _corpora[key] = ex.Corpus(_split_docs(spark, data).drop("tokens"), cleaned="clean_text")
    return _corpora[key]


_corpora: dict[tuple[str, str], ex.Corpus] = {}


@query("evaluate_config")
def evaluate_config(spark: SparkSession, data: str) -> DataFrame:
    fitted = ex.fit(Setup("porter_l2", Tokens("custom", "porter", 2)),
                    _corpus(spark, data))
    return ex.summarise(fitted)


@query("ablation_preprocessing")
def ablation_preprocessing(spark: SparkSession, data: str) -> DataFrame:
    return ex.run_group(PREPROCESSING_GROUP, _corpus(spark, data))


@query("compare_features")
def compare_features(spark: SparkSession, data: str) -> DataFrame:
    return ex.run_group(FEATURE_GROUP, _corpus(spark, data))


@query("compare_models")
def compare_models(spark: SparkSession, data: str) -> DataFrame:
    """Every model configuration; the best of each family becomes version 1."""
    rows = settle(ex.run_group(MODEL_GROUP, _corpus(spark, data)))
    best = registry.best_per_family(rows, score="weighted_f1").select(
        "family", "run_order", F.lit("Production").alias("stage"))
    return rows.join(best, ["family", "run_order"], "left")


@query("stopword_effect")
def stopword_effect(spark: SparkSession, data: str) -> DataFrame:
    """Each stopword list taken out of the words, on the same random split."""
    return combine([_evaluated(_wide_features(spark, data, "tfidf", name), f"{name}_stopwords") for name in ("default", "custom")])


@query("compare_methods")
def compare_methods(spark: SparkSession, data: str) -> DataFrame:
    """Language model, Naive Bayes, linear and polynomial models side by side."""
    columns = ["name", "accuracy", "f1"]
    rows = [metrics.evaluate(lm_classify(spark, data)).select(F.lit("language_model").alias("name"), "accuracy", "f1"),
            metrics.evaluate(nb_best(spark, data)).select(F.lit("naive_bayes").alias("name"), "accuracy", "f1"),
            lr_variants(spark, data).select(F.concat(F.lit("logistic_"), "name").alias("name"), "accuracy", "f1"),
            poly_lr(spark, data).select(F.concat(F.lit("polynomial_"), "degree").alias("name"),
                                        F.col("test_accuracy").alias("accuracy"), "f1")]
    return combine([r.select(*columns) for r in rows])

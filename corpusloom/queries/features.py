"""Vocabulary, bag-of-words, TF-IDF, retrieval and similarity queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import stopwords
from ..functions.tokens import in_list
from ..operators import terms
from . import sql
from .base import document_postings, document_terms, labelled, labelled_postings, query, table

MAX_FEATURES = 20000
N_DOCS = "SELECT count(*) FROM corpus"


@query("vocabulary_top", f"""WITH {sql.POSTINGS}, {sql.vocab(5000)}
SELECT term, corpus_tf, df FROM vocab""")
def vocabulary_top(spark: SparkSession, data: str) -> DataFrame:
    return terms.vocabulary(labelled_postings(spark, data), 5000)


@query("bow", f"""WITH {sql.POSTINGS}, {sql.vocab(MAX_FEATURES)}
SELECT doc_id, label, term, tf FROM post JOIN vocab USING (term)""")
def bow(spark: SparkSession, data: str) -> DataFrame:
    post = labelled_postings(spark, data)
    return terms.bow(post, terms.vocabulary(post, MAX_FEATURES)).select("doc_id", "label", "term", "tf")


@query("bow_sparsity", f"""WITH {sql.POSTINGS}, {sql.vocab(MAX_FEATURES)},
s AS (SELECT (SELECT count(*) FROM corpus) AS n_docs, (SELECT count(*) FROM vocab) AS n_terms,
        (SELECT count(*) FROM post JOIN vocab USING (term)) AS nnz)
SELECT n_docs, n_terms, nnz, round(1.0 - nnz::DOUBLE / (n_docs::DOUBLE * n_terms::DOUBLE), 6) AS sparsity
FROM s""")
def bow_sparsity(spark: SparkSession, data: str) -> DataFrame:
    post = labelled_postings(spark, data)
    vocab = terms.vocabulary(post, MAX_FEATURES)
    return terms.sparsity(terms.bow(post, vocab), labelled(spark, data), vocab)


@query("top_terms_per_class", f"""WITH {sql.POSTINGS}, {sql.vocab(MAX_FEATURES)},
s AS (SELECT label, term, sum(tf)::BIGINT AS total FROM post JOIN vocab USING (term) GROUP BY ALL)
SELECT label, term, total, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY total DESC, term) AS rank FROM s)
WHERE rank <= 30""")
def top_terms_per_class(spark: SparkSession, data: str) -> DataFrame:
    post = labelled_postings(spark, data)
    return terms.top_terms_per_class(terms.bow(post, terms.vocabulary(post, MAX_FEATURES)), 30)


def _weights(spark: SparkSession, data: str, smooth: bool, sublinear: bool) -> DataFrame:
    return terms.tfidf(labelled_postings(spark, data), labelled(spark, data), smooth, sublinear, MAX_FEATURES)


_VARIANTS = {"standard": (False, False), "smooth": (True, False), "sublinear": (False, True)}


def _register_variant(name: str, smooth: bool, sublinear: bool) -> None:
    @query(f"tfidf_{name}", f"""WITH {sql.POSTINGS}, {sql.vocab(MAX_FEATURES)},
{sql.weights(N_DOCS, smooth, sublinear)}
SELECT doc_id, label, term, tf, round(weight, 6) AS weight FROM w""")
    def run(spark: SparkSession, data: str) -> DataFrame:
        return _weights(spark, data, smooth, sublinear).select(
            "doc_id", "label", "term", "tf", F.round("weight", 6).alias("weight"))


for _name, (_smooth, _sub) in _VARIANTS.items():
    _register_variant(_name, _smooth, _sub)


def _top_sql(name: str, smooth: bool, sublinear: bool) -> str:
    return f"""SELECT '{name}' AS variant, label, term, score, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, term) AS rank FROM (
    SELECT w.label, w.term, round(sum(w.weight) / any_value(c.n), 6) AS score
    FROM w_{name} w JOIN (SELECT label, count(*) AS n FROM corpus GROUP BY label) c ON w.label = c.label
    GROUP BY w.label, w.term))
WHERE rank <= 15"""


@query("top_tfidf_terms", f"""WITH {sql.POSTINGS}, {sql.vocab(MAX_FEATURES)},
{", ".join(sql.weights(N_DOCS, s, b, name=f'w_{n}') for n, (s, b) in _VARIANTS.items())}
{" UNION ALL ".join(_top_sql(n, s, b) for n, (s, b) in _VARIANTS.items())}""")
def top_tfidf_terms(spark: SparkSession, data: str) -> DataFrame:
    parts = None
    for name, (smooth, sub) in _VARIANTS.items():
        part = terms.top_tfidf_terms(_weights(spark, data, smooth, sub), labelled(spark, data), 15)
        part = part.select(F.lit(name).alias("variant"), "label", "term", "score", "rank")
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query("discriminative_terms", f"""WITH {sql.POSTINGS}, {sql.vocab(MAX_FEATURES)},
{sql.weights(N_DOCS, False, False)}
SELECT term, round(
  sum(CASE WHEN label = 'fake' THEN weight ELSE 0.0 END) / (SELECT count(*) FROM corpus WHERE label = 'fake')
  - sum(CASE WHEN label = 'real' THEN weight ELSE 0.0 END) / (SELECT count(*) FROM corpus WHERE label = 'real'),
  6) AS diff
FROM w GROUP BY term ORDER BY diff DESC, term LIMIT 15""")
def discriminative_terms(spark: SparkSession, data: str) -> DataFrame:
    return terms.discriminative_terms(_weights(spark, data, False, False), labelled(spark, data), 15)


def _stop_sql(name: str) -> str:
    return f"""post_{name} AS (SELECT * FROM post WHERE term NOT IN {sql.word_list(stopwords(name))}),
{sql.vocab(MAX_FEATURES, f'post_{name}', f'vocab_{name}')},
{sql.weights(N_DOCS, True, False, f'post_{name}', f'vocab_{name}', f'w_{name}')}"""


@query("tfidf_stopwords", f"""WITH {sql.POSTINGS}, {_stop_sql('default')}, {_stop_sql('custom')}
SELECT 'default' AS list, doc_id, term, round(weight, 6) AS weight FROM w_default
UNION ALL SELECT 'custom', doc_id, term, round(weight, 6) FROM w_custom""")
def tfidf_stopwords(spark: SparkSession, data: str) -> DataFrame:
    parts = None
    for name in ("default", "custom"):
        kept = labelled_postings(spark, data).filter(~in_list(F.col("term"), stopwords(name)))
        part = terms.tfidf(kept, labelled(spark, data), True, False, MAX_FEATURES).select(
            F.lit(name).alias("list"), "doc_id", "term", F.round("weight", 6).alias("weight"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


# --- transform, retrieval, similarity ---------------------------------------------

from ..functions.text import clean_text  # noqa: E402
from ..functions.tokens import tokenize  # noqa: E402
from ..operators import retrieve  # noqa: E402
from .base import labelled_raw, shared  # noqa: E402

N_ALL = "SELECT count(*) FROM docs"
QUERY_SQL = f"""qpost AS (SELECT query_id, term, count(*) AS tf FROM (
  SELECT item_id AS query_id, unnest({sql.words(sql.clean('text'))}) AS term FROM benchmark) GROUP BY ALL)"""
CORPUS_SQL = f"""{sql.DOC_POSTINGS}, {sql.vocab(MAX_FEATURES)},
{sql.weights(N_ALL, False, False, cols='doc_id')}"""


def _query_postings(spark: SparkSession, data: str) -> DataFrame:
    toks = table(spark, data, "benchmark").select(
        F.col("item_id").alias("doc_id"), tokenize(clean_text(F.col("text")), "word").alias("tokens"))
    return terms.postings(toks).withColumnRenamed("doc_id", "query_id")


def _corpus_idf(spark: SparkSession, data: str) -> DataFrame:
    return shared(spark, data, "corpus_idf", lambda: terms.idf(
        terms.vocabulary(document_postings(spark, data), MAX_FEATURES), table(spark, data, "documents"), False))


def _corpus_weights(spark: SparkSession, data: str) -> DataFrame:
    return shared(spark, data, "corpus_weights", lambda: terms.weigh(
        document_postings(spark, data), _corpus_idf(spark, data)))


@query("tfidf_transform", f"""WITH {CORPUS_SQL}, {QUERY_SQL},
{sql.weights(N_ALL, False, False, 'qpost', name='qw', cols='query_id', key='query_id')}
SELECT query_id, term, round(weight, 6) AS weight FROM qw""")
def tfidf_transform(spark: SparkSession, data: str) -> DataFrame:
    return terms.weigh(_query_postings(spark, data), _corpus_idf(spark, data), doc="query_id").select(
        "query_id", "term", F.round("weight", 6).alias("weight"))


@query("retrieve_topk", f"""WITH {CORPUS_SQL}, {QUERY_SQL},
{sql.weights(N_ALL, False, False, 'qpost', name='qw', cols='query_id', key='query_id')},
s AS (SELECT qw.query_id, w.doc_id, round(sum(qw.weight * w.weight), 6) AS cosine FROM qw JOIN w ON qw.term = w.term GROUP BY ALL)
SELECT query_id, doc_id, cosine, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, doc_id) AS rank FROM s) WHERE rank <= 10""")
def retrieve_topk(spark: SparkSession, data: str) -> DataFrame:
    queries = terms.weigh(_query_postings(spark, data), _corpus_idf(spark, data), doc="query_id")
    return retrieve.top_k(queries, _corpus_weights(spark, data), 10)


@query("retrieve_claims", f"""WITH {sql.POSTINGS}, {sql.vocab(5000)},
{sql.weights('SELECT count(*) FROM corpus', True, False)}, {QUERY_SQL},
{sql.weights('SELECT count(*) FROM corpus', True, False, 'qpost', name='qw', cols='query_id', key='query_id')},
s AS (SELECT qw.query_id, w.doc_id, round(sum(qw.weight * w.weight), 6) AS cosine FROM qw JOIN w ON qw.term = w.term GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, doc_id) AS rank FROM s)
SELECT r.query_id, c.doc_id, md5(c.clean_text) AS claim_md5, c.label, c.source, r.cosine AS cosine_similarity, r.rank::INTEGER AS rank
FROM r JOIN corpus c ON c.doc_id = r.doc_id WHERE rank <= 5""")
def retrieve_claims(spark: SparkSession, data: str) -> DataFrame:
    corpus = labelled(spark, data)
    post = labelled_postings(spark, data)
    idfs = terms.idf(terms.vocabulary(post, 5000), corpus)
    queries = terms.weigh(_query_postings(spark, data), idfs, doc="query_id")
    best = retrieve.top_k(queries, terms.weigh(post, idfs), 5)
    return best.join(corpus, "doc_id").select(
        "query_id", "doc_id", F.md5("clean_text").alias("claim_md5"), "label", "source",
        F.col("cosine").alias("cosine_similarity"), "rank")


@query("similar_pairs", f"""WITH {CORPUS_SQL},
bags AS (SELECT doc_id, string_agg(term || ':' || tf, ' ' ORDER BY term) AS bag FROM w GROUP BY doc_id),
reps AS (SELECT min(doc_id) AS doc_id, count(*) AS copies FROM bags GROUP BY bag),
u AS (SELECT w.doc_id, w.term, w.weight, r.copies FROM w JOIN reps r ON r.doc_id = w.doc_id)
SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, a.copies AS copies_a, b.copies AS copies_b,
  round(sum(a.weight * b.weight), 6) AS cosine
FROM u a JOIN u b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY ALL HAVING round(sum(a.weight * b.weight), 6) >= 0.8""")
def similar_pairs(spark: SparkSession, data: str) -> DataFrame:
    return retrieve.similar_pairs(_corpus_weights(spark, data), 0.8)


@query("copy_membership", f"""WITH {CORPUS_SQL},
bags AS (SELECT doc_id, string_agg(term || ':' || tf, ' ' ORDER BY term) AS bag FROM w GROUP BY doc_id)
SELECT doc_id, min(doc_id) OVER (PARTITION BY bag) AS rep, count(*) OVER (PARTITION BY bag) AS copies FROM bags""")
def copy_membership(spark: SparkSession, data: str) -> DataFrame:
    """Which documents each side of ``similar_pairs`` stands for."""
    return retrieve.copy_groups(_corpus_weights(spark, data))


@query("corpus_centrality", f"""WITH {CORPUS_SQL}, c AS (SELECT term, sum(weight) AS s FROM w GROUP BY term)
SELECT doc_id, round(sum(w.weight * c.s) / ({N_ALL}), 6) AS score FROM w JOIN c ON w.term = c.term
GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 10""")
def corpus_centrality(spark: SparkSession, data: str) -> DataFrame:
    """The weights are computed twice: kept as a row a term they would be several times the texts."""
    weights = terms.weigh_packed(document_terms(spark, data), _corpus_idf(spark, data))
    return retrieve.centrality(weights, table(spark, data, "documents"), 10)

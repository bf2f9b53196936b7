"""Cleaning, tokenising, normalising and noise queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import tokens as tk
from ..functions.fixed import ROMAN_URDU, STOPWORDS_ADDED, STOPWORDS_KEPT, stopwords
from ..operators import audit, terms
from ..operators.corpus import combine, drop_blank
from ..plans.config import Setup, Tokens
from ..plans.preprocess import preprocess
from ..session import widen
from . import sql
from .base import (document_postings, documents, labelled, labelled_postings, query, shared, table)

CUSTOM_STOP = sql.word_list(stopwords("custom"))
DEFAULT_STOP = sql.word_list(stopwords("default"))


@query("clean_text", f"SELECT doc_id, {sql.clean('text')} AS clean_text FROM documents")
def clean_text(spark: SparkSession, data: str) -> DataFrame:
    return widen(table(spark, data, "documents").select("doc_id", "text")).select("doc_id", tx.clean_text(F.col("text")).alias("clean_text"))


@query("html_unescape", f"SELECT page_id, {sql.unescape('html')} AS decoded FROM pages")
def html_unescape(spark: SparkSession, data: str) -> DataFrame:
    return table(spark, data, "pages").select("page_id", tx.html_unescape(F.col("html")).alias("decoded"))


@query("strip_markup", f"""SELECT page_id, {sql.markup('html')} AS stripped FROM pages""")
def strip_markup(spark: SparkSession, data: str) -> DataFrame:
    return table(spark, data, "pages").select("page_id", tx.strip_markup(F.col("html")).alias("stripped"))


@query("squeeze_punct", f"SELECT doc_id, {sql.squeeze('text')} AS squeezed FROM documents")
def squeeze_punct(spark: SparkSession, data: str) -> DataFrame:
    return table(spark, data, "documents").select(
        "doc_id", tx.squeeze_punctuation(F.col("text")).alias("squeezed"))


@query("strip_emoji", f"SELECT doc_id, {sql.sub('text', sql.EMOJI)} AS stripped FROM documents")
def strip_emoji(spark: SparkSession, data: str) -> DataFrame:
    return table(spark, data, "documents").select("doc_id", tx.strip_emoji(F.col("text")).alias("stripped"))


@query("dictionary_replace", f"SELECT doc_id, {sql.dictionary('lower(text)')} AS replaced FROM documents")
def dictionary_replace(spark: SparkSession, data: str) -> DataFrame:
    return table(spark, data, "documents").select(
        "doc_id", tx.replace_words(F.lower("text")).alias("replaced"))


@query("tokenize_custom", f"""WITH {sql.DOCS}, t AS (SELECT doc_id, {sql.custom('clean_text')} AS k FROM docs)
SELECT doc_id, len(k)::INTEGER AS n_tokens, array_to_string(k, ' ') AS tokens FROM t""")
def tokenize_custom(spark: SparkSession, data: str) -> DataFrame:
    toks = documents(spark, data).select("doc_id", tk.tokenize(F.col("clean_text"), "custom").alias("k"))
    return toks.select("doc_id", F.size("k").alias("n_tokens"), F.array_join("k", " ").alias("tokens"))


@query("tokenize_word", f"""WITH {sql.DOCS}, t AS (SELECT doc_id, {sql.words('clean_text')} AS k FROM docs)
SELECT doc_id, len(k)::INTEGER AS n_tokens, array_to_string(k, ' ') AS tokens FROM t""")
def tokenize_word(spark: SparkSession, data: str) -> DataFrame:
    return documents(spark, data).select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


@query("remove_stopwords", f"""WITH {sql.DOCS}, t AS (SELECT doc_id, {sql.custom('clean_text')} AS k FROM docs)
SELECT doc_id,
  array_to_string(list_filter(k, lambda x: lower(x) NOT IN {CUSTOM_STOP}), ' ') AS kept,
  array_to_string(list_filter(k, lambda x: lower(x) IN {CUSTOM_STOP}), ' ') AS removed
FROM t""")
def remove_stopwords(spark: SparkSession, data: str) -> DataFrame:
    toks = documents(spark, data).select("doc_id", tk.tokenize(F.col("clean_text"), "custom").alias("k"))
    return toks.select("doc_id",
                       F.array_join(tk.remove_stopwords(F.col("k"), "custom"), " ").alias("kept"),
                       F.array_join(tk.removed_stopwords(F.col("k"), "custom"), " ").alias("removed"))


@query("token_fallback", f"""WITH t AS (
  SELECT conv_id, turn, clean_text, list_filter({sql.custom('clean_text')}, lambda x: length(x) >= 12) AS k
  FROM (SELECT conv_id, turn, {sql.clean('text')} AS clean_text FROM conversations))
SELECT conv_id, turn, CASE WHEN len(k) > 0 THEN array_to_string(k, ' ')
  WHEN trim(clean_text) <> '' THEN trim(clean_text) ELSE 'empty' END AS tokens FROM t""")
def token_fallback(spark: SparkSession, data: str) -> DataFrame:
    turns = table(spark, data, "conversations").select(
        "conv_id", "turn", tx.clean_text(F.col("text")).alias("clean_text"))
    kept = tk.keep_long(tk.tokenize(F.col("clean_text"), "custom"), 12)
    return turns.select("conv_id", "turn",
                        F.array_join(tk.or_fallback(kept, F.col("clean_text")), " ").alias("tokens"))


@query("preprocess_configured", f"""WITH {sql.LABELLED},
t AS (SELECT doc_id, label, source, clean_text, {sql.custom('clean_text')} AS k FROM corpus),
f AS (SELECT *, list_filter(k, lambda x: lower(x) NOT IN {CUSTOM_STOP} AND length(x) >= 2) AS kept,
        list_filter(k, lambda x: lower(x) IN {CUSTOM_STOP}) AS removed FROM t)
SELECT doc_id, label, source, array_to_string(removed, ' ') AS removed_stopwords,
  CASE WHEN len(kept) > 0 THEN array_to_string(kept, ' ') ELSE clean_text END AS processed_text,
  CASE WHEN len(kept) > 0 THEN len(kept) ELSE 1 END::INTEGER AS n_tokens
FROM f""")
def preprocess_configured(spark: SparkSession, data: str) -> DataFrame:
    config = Setup("plain", Tokens("custom", min_token_length=2))
    done = preprocess(labelled(spark, data).drop("tokens"), config, cleaned="clean_text")
    return done.select("doc_id", "label", "source", "processed_text",
                       F.array_join("removed_stopwords", " ").alias("removed_stopwords"),
                       F.size("tokens").alias("n_tokens"))


@query("ngrams_padded", f"""WITH {sql.DOCS},
t AS (SELECT doc_id, list_concat(['<s>', '<s>'], {sql.custom('clean_text')}, ['</s>']) AS p FROM docs),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(p) - 1), lambda i: p[i] || ' ' || p[i + 1] || ' ' || p[i + 2])) AS gram FROM t)
SELECT gram, count(*) AS n, count(DISTINCT doc_id) AS docs FROM g GROUP BY gram""")
def ngrams_padded(spark: SparkSession, data: str) -> DataFrame:
    grams = documents(spark, data).select(
        "doc_id", tk.tokenize(F.col("clean_text"), "custom").alias("k")).select(
        "doc_id", F.explode(tk.ngrams(F.col("k"), 3)).alias("g")).select(
        "doc_id", F.concat_ws(" ", "g.w1", "g.w2", "g.w3").alias("gram"))
    # two plain counts instead of a distinct: per document first, then overall
    per_doc = grams.groupBy("doc_id", "gram").agg(F.count(F.lit(1)).alias("c"))
    return per_doc.groupBy("gram").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("docs"))


# --- noise and tokeniser reports -------------------------------------------------

def _audit_sql(src: str) -> str:
    flags = {"html_tags": sql.TAG, "urls": sql.URL, "handles": f"@{sql.W}+", "emojis": sql.EMOJI,
             "repeated_punctuation": "([!?.]){2,}"}
    keys = sql.word_list(list(ROMAN_URDU))
    cols = ", ".join(f"regexp_matches(html, {sql.q(p)})::INTEGER AS {n}" for n, p in flags.items())
    runs = f"[^{sql.SP}]+"
    return f"""audit AS (SELECT page_id, {cols},
  len(list_filter({sql.find_all('html', sql.WORD)}, lambda x: lower(x) IN {keys}))::INTEGER AS roman_urdu_terms,
  len({sql.find_all('html', runs)})::INTEGER AS before_length,
  len({sql.find_all(sql.clean('html'), runs)})::INTEGER AS after_length FROM {src})"""


def _audit(spark: SparkSession, data: str) -> DataFrame:
    return audit.noise_audit(widen(table(spark, data, "pages").select("page_id", "html")), "html", ["page_id"])


@query("noise_audit", f"WITH {_audit_sql('pages')} SELECT * FROM audit")
def noise_audit(spark: SparkSession, data: str) -> DataFrame:
    return _audit(spark, data)


@query("noise_audit_summary", f"WITH {_audit_sql('pages')} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS metric, count({c}) AS count, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min, round(quantile_cont({c}, 0.25), 6) AS q25,
  round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75,
  max({c})::DOUBLE AS max FROM audit""" for c in audit.NOISE_COLUMNS))
def noise_audit_summary(spark: SparkSession, data: str) -> DataFrame:
    return audit.describe(_audit(spark, data), audit.NOISE_COLUMNS)


def _tokenizer_sql() -> str:
    contraction = sql.q(r"(\p{L})(n't|'(?:s|m|d|ll|re|ve))([^\p{L}\p{N}_']|$)")
    tree = sql.find_all(f"regexp_replace(clean_text, {contraction}, '\\1 \\2\\3', 'g')",
                        rf"n't|'(?:s|m|d|ll|re|ve)|{sql.WORD}|[^{sql.SP}\p{{L}}\p{{N}}_]")
    keys = sql.word_list(list(ROMAN_URDU))
    return f"""WITH {sql.DOCS},
lex AS (SELECT DISTINCT unnest({sql.words(sql.clean('text'))}) AS term FROM benchmark),
m AS (SELECT doc_id, 'custom' AS method, {sql.custom('clean_text')} AS k FROM docs
  UNION ALL SELECT doc_id, 'word', {sql.words('clean_text')} FROM docs
  UNION ALL SELECT doc_id, 'treebank', {tree} FROM docs),
o AS (SELECT doc_id, method, count(*) AS n, sum(CASE WHEN regexp_full_match(t, '\\p{{L}}+')
        AND lower(t) NOT IN (SELECT term FROM lex) THEN 1 ELSE 0 END) AS bad
  FROM (SELECT doc_id, method, unnest(k) AS t FROM m) GROUP BY ALL)
SELECT method, count(*) AS documents, round(avg(len(k)), 6) AS avg_tokens,
  round(avg(len(list_filter(k, lambda x: contains(x, '''')))), 6) AS avg_contractions,
  round(avg(len(list_filter(k, lambda x: lower(x) IN {keys}))), 6) AS avg_roman_terms,
  round((SELECT coalesce(sum(o.bad::DOUBLE / o.n), 0) FROM o WHERE o.method = m.method) / count(*), 6) AS avg_oov_rate
FROM m GROUP BY method"""


def _benchmark_lexicon(spark: SparkSession, data: str) -> DataFrame:
    return table(spark, data, "benchmark").select(
        F.explode(tk.tokenize(tx.clean_text(F.col("text")), "word")).alias("term"))


@query("tokenizer_compare", _tokenizer_sql())
def tokenizer_compare(spark: SparkSession, data: str) -> DataFrame:
    return audit.compare_tokenizers(documents(spark, data).select("doc_id", "clean_text"),
                                    _benchmark_lexicon(spark, data))


@query("oov_rate", f"""WITH {sql.DOC_POSTINGS},
lex AS (SELECT DISTINCT unnest({sql.words(sql.clean('text'))}) AS term FROM benchmark)
SELECT doc_id, sum(tf)::BIGINT AS tokens,
  sum(CASE WHEN regexp_full_match(term, '\\p{{L}}+') AND term NOT IN (SELECT term FROM lex) THEN tf ELSE 0 END)::BIGINT AS unknown,
  round(sum(CASE WHEN regexp_full_match(term, '\\p{{L}}+') AND term NOT IN (SELECT term FROM lex) THEN tf ELSE 0 END)::DOUBLE / sum(tf), 6) AS oov_rate
FROM post GROUP BY doc_id""")
def oov_rate(spark: SparkSession, data: str) -> DataFrame:
    rates = audit.oov_by_document(document_postings(spark, data).withColumnRenamed("term", "token"),
                                  _benchmark_lexicon(spark, data), ["doc_id"])
    return rates.withColumn("oov_rate", F.round("oov_rate", 6))


@query("stopword_removal_rate", f"""WITH {sql.LABELLED},
t AS (SELECT unnest({sql.custom('clean_text')}) AS k FROM corpus),
s AS (SELECT count(*) AS tokens, count(*) FILTER (lower(k) IN {DEFAULT_STOP}) AS removed_default,
  count(*) FILTER (lower(k) IN {CUSTOM_STOP}) AS removed_custom FROM t)
SELECT *, round(removed_default::DOUBLE / tokens, 6) AS default_rate,
  round(removed_custom::DOUBLE / tokens, 6) AS custom_rate FROM s""")
def stopword_removal_rate(spark: SparkSession, data: str) -> DataFrame:
    return audit.removal_rates(labelled(spark, data).select(
        tk.tokenize(F.col("clean_text"), "custom").alias("tokens")))


@query("stopword_anti_join", f"""WITH {sql.POSTINGS}
SELECT doc_id, sum(CASE WHEN term NOT IN {DEFAULT_STOP} THEN tf ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN term IN {DEFAULT_STOP} THEN tf ELSE 0 END)::BIGINT AS removed
FROM post GROUP BY doc_id""")
def stopword_anti_join(spark: SparkSession, data: str) -> DataFrame:
    words = spark.createDataFrame([(w,) for w in stopwords("default")], "term string")
    small = F.broadcast(words)  # fixed word list
    post = labelled_postings(spark, data)
    kept = post.join(small, "term", "left_anti").select("doc_id", F.col("tf").alias("kept"), F.lit(0).cast("long").alias("removed"))
    gone = post.join(small, "term", "left_semi").select("doc_id", F.lit(0).cast("long").alias("kept"), F.col("tf").alias("removed"))
    return kept.unionByName(gone).groupBy("doc_id").agg(F.sum("kept").alias("kept"), F.sum("removed").alias("removed"))


@query("stopword_set_algebra", f"""WITH {sql.POSTINGS},
word(w) AS (VALUES {", ".join(f"({sql.q(w)})" for w in sorted(set(stopwords('default')) | set(STOPWORDS_ADDED)))}),
s AS (SELECT term, sum(tf)::BIGINT AS corpus_tf FROM post GROUP BY term)
SELECT w AS word, w IN {DEFAULT_STOP} AS in_default,
  ((w IN {DEFAULT_STOP} AND w NOT IN {sql.word_list(STOPWORDS_KEPT)}) OR w IN {sql.word_list(STOPWORDS_ADDED)}) AS in_custom,
  coalesce(corpus_tf, 0) AS corpus_tf
FROM word LEFT JOIN s ON s.term = w""")
def stopword_set_algebra(spark: SparkSession, data: str) -> DataFrame:
    def frame(words: list[str]) -> DataFrame:
        return spark.createDataFrame([(w,) for w in words], "word string")

    default = frame(stopwords("default"))
    custom = default.subtract(frame(STOPWORDS_KEPT)).union(frame(STOPWORDS_ADDED)).distinct()
    flags = (default.withColumn("in_default", F.lit(True))
             .join(custom.withColumn("in_custom", F.lit(True)), "word", "full"))
    used = (labelled_postings(spark, data).join(F.broadcast(flags.select(F.col("word").alias("term"))), "term")
            .groupBy(F.col("term").alias("word")).agg(F.sum("tf").alias("corpus_tf")))
    return flags.join(used, "word", "left").select(
        "word", F.coalesce("in_default", F.lit(False)).alias("in_default"),
        F.coalesce("in_custom", F.lit(False)).alias("in_custom"),
        F.coalesce("corpus_tf", F.lit(0).cast("long")).alias("corpus_tf"))


@query("filter_blank", f"""SELECT page_id, length(body)::INTEGER AS n_chars FROM (
  SELECT page_id, {sql.sub('html', sql.TAG)} AS body FROM pages)
WHERE regexp_matches(body, {sql.q(f'[^{sql.SP}]')})""")
def filter_blank(spark: SparkSession, data: str) -> DataFrame:
    body = table(spark, data, "pages").select("page_id", tx.strip_tags(F.col("html")).alias("body"))
    return drop_blank(body, "body").select("page_id", F.char_length("body").alias("n_chars"))


# --- word normalisers over the corpus vocabulary -------------------------------------

from ..functions.stems import stem_column  # noqa: E402
from . import stemsql  # noqa: E402


def _vocabulary(spark: SparkSession, data: str) -> DataFrame:
    """Terms and their counts, which every normaliser starts from."""
    return shared(spark, data, "vocabulary", lambda: terms.term_stats(labelled_postings(spark, data)))


def _stemmed(spark: SparkSession, data: str, algorithm: str) -> DataFrame:
    return shared(spark, data, f"stems_{algorithm}", lambda: stem_column(
        _vocabulary(spark, data), "term", algorithm, "stem"))


VOCAB_SQL = f"""{sql.POSTINGS},
voc AS (SELECT term, sum(tf)::BIGINT AS corpus_tf FROM post GROUP BY term)"""


@query("stem_porter", f"WITH {VOCAB_SQL}, {stemsql.porter('voc', 'porter')} SELECT term, stem FROM porter")
def stem_porter(spark: SparkSession, data: str) -> DataFrame:
    return _stemmed(spark, data, "porter").select("term", "stem")


@query("stem_snowball", f"WITH {VOCAB_SQL}, {stemsql.snowball('voc', 'snowball')} SELECT term, stem FROM snowball")
def stem_snowball(spark: SparkSession, data: str) -> DataFrame:
    return _stemmed(spark, data, "snowball").select("term", "stem")


LEMMA_SQL = stemsql.lemmas("voc", "lem")


def _lemmas(spark: SparkSession, data: str) -> DataFrame:
    vocab = _vocabulary(spark, data).select("term")
    return audit.lemmas(vocab, vocab)


@query("lemmatize_dictionary", f"WITH {VOCAB_SQL}, {LEMMA_SQL} SELECT term, lemma FROM lem")
def lemmatize_dictionary(spark: SparkSession, data: str) -> DataFrame:
    return _lemmas(spark, data)


def _forms(spark: SparkSession, data: str) -> DataFrame:
    """Vocabulary with every normal form next to its term and count."""
    porter = _stemmed(spark, data, "porter").select("term", "corpus_tf", F.col("stem").alias("porter"))
    snowball = _stemmed(spark, data, "snowball").select("term", F.col("stem").alias("snowball"))
    return porter.join(snowball, "term").join(_lemmas(spark, data), "term")


def _by_method(spark: SparkSession, data: str) -> DataFrame:
    forms = _forms(spark, data)
    return forms.select("term", "corpus_tf", F.explode(F.array(*[
        F.struct(F.lit(name).alias("method"), F.col(col).alias("form")) for name, col in (
            ("identity", "term"), ("porter", "porter"), ("snowball", "snowball"), ("lemmatizer", "lemma"))])).alias("m")
    ).select("term", "corpus_tf", "m.method", "m.form")


_FORMS_SQL = f"""WITH {VOCAB_SQL}, {stemsql.porter('voc', 'porter')}, {stemsql.snowball('voc', 'snowball')}, {LEMMA_SQL},
forms AS (SELECT 'identity' AS method, term, corpus_tf, term AS form FROM voc
  UNION ALL SELECT 'porter', p.term, v.corpus_tf, p.stem FROM porter p JOIN voc v ON v.term = p.term
  UNION ALL SELECT 'snowball', p.term, v.corpus_tf, p.stem FROM snowball p JOIN voc v ON v.term = p.term
  UNION ALL SELECT 'lemmatizer', p.term, v.corpus_tf, p.lemma FROM lem p JOIN voc v ON v.term = p.term)"""


@query("normaliser_vocab", f"{_FORMS_SQL} SELECT method, count(DISTINCT form) AS vocabulary_size FROM forms GROUP BY method")
def normaliser_vocab(spark: SparkSession, data: str) -> DataFrame:
    forms = _by_method(spark, data).select("method", "form").distinct()
    return forms.groupBy("method").agg(F.count(F.lit(1)).alias("vocabulary_size"))


@query("normaliser_collisions", f"""{_FORMS_SQL}
SELECT method, (sum(corpus_tf) - count(DISTINCT form))::BIGINT AS collisions, count(*) - count(DISTINCT form) AS merged_words
FROM forms GROUP BY method""")
def normaliser_collisions(spark: SparkSession, data: str) -> DataFrame:
    # tokens minus distinct forms, and words that share a form with another word
    forms = _by_method(spark, data).groupBy("method", "form").agg(
        F.sum("corpus_tf").alias("tokens"), F.count(F.lit(1)).alias("words"))
    return forms.groupBy("method").agg(
        (F.sum("tokens") - F.count(F.lit(1))).alias("collisions"),
        (F.sum("words") - F.count(F.lit(1))).alias("merged_words"))


@query("normaliser_term_map", f"""{_FORMS_SQL}
SELECT p.term, p.stem AS porter, s.stem AS snowball, l.lemma AS lemmatizer
FROM porter p JOIN snowball s ON s.term = p.term JOIN lem l ON l.term = p.term""")
def normaliser_term_map(spark: SparkSession, data: str) -> DataFrame:
    return _forms(spark, data).select("term", "porter", "snowball", F.col("lemma").alias("lemmatizer"))


def _profiles_sql() -> str:
    contraction = sql.q(r"(\p{L})(n't|'(?:s|m|d|ll|re|ve))([^\p{L}\p{N}_']|$)")
    split = f"regexp_replace(clean_text, {contraction}, '\\1 \\2\\3', 'g')"
    other = rf"[^{sql.SP}\p{{L}}\p{{N}}_]"
    cut = sql.find_all(split, rf"n't|'(?:s|m|d|ll|re|ve)|{sql.WORD}|{other}")
    whole = sql.find_all(split, rf"n't|'(?:s|m|d|ll|re|ve)|\.{{2,}}|\p{{N}}+(?:[.,]\p{{N}}+)+|{sql.WORD}(?:-{sql.WORD})*|{other}")
    return f"""WITH {sql.DOCS}
SELECT doc_id, 'spacy' AS profile, len({cut})::INTEGER AS n_tokens, md5(array_to_string({cut}, ' ')) AS tokens FROM docs
UNION ALL SELECT doc_id, 'nltk', len({whole})::INTEGER, md5(array_to_string({whole}, ' ')) FROM docs"""


@query("tokenize_profiles", _profiles_sql())
def tokenize_profiles(spark: SparkSession, data: str) -> DataFrame:
    """The two named profiles differ in hyphenated words, numbers and runs of dots."""
    docs = documents(spark, data).select("doc_id", "clean_text")
    return combine([docs.select("doc_id", F.lit(p).alias("profile"), tk.tokenize(F.col("clean_text"), p).alias("k")).select(
        "doc_id", "profile", F.size("k").alias("n_tokens"), F.md5(F.array_join("k", " ")).alias("tokens")) for p in ("spacy", "nltk")])


# --- the preprocessing switch with each normaliser ----------------------------------


def _switched_sql(normaliser: str, form: str) -> str:
    """Tokens in order, each replaced by its normal form, short ones dropped, empty lists filled."""
    return f"""WITH {sql.LABELLED},
kept AS (SELECT doc_id, clean_text, list_filter({sql.custom('clean_text')}, lambda x: lower(x) NOT IN {CUSTOM_STOP}) AS k FROM corpus),
placed AS (SELECT doc_id, unnest(k) AS term, generate_subscripts(k, 1) AS at FROM kept),
voc AS (SELECT DISTINCT term FROM placed),
{normaliser},
forms AS (SELECT doc_id, list(n.{form} ORDER BY p.at) FILTER (length(n.{form}) >= 2 AND trim(n.{form}) <> '') AS f
  FROM placed p JOIN norm n ON n.term = p.term GROUP BY doc_id)
SELECT kept.doc_id, CASE WHEN len(f) > 0 THEN array_to_string(f, ' ') WHEN trim(clean_text) <> '' THEN trim(clean_text) ELSE 'empty' END AS processed_text
FROM kept LEFT JOIN forms ON forms.doc_id = kept.doc_id"""


def _switched(spark: SparkSession, data: str, normalization: str) -> DataFrame:
    config = Setup(normalization, Tokens("custom", normalization, 2))
    return preprocess(labelled(spark, data).drop("tokens"), config, cleaned="clean_text").select("doc_id", "processed_text")


@query("preprocess_porter", _switched_sql(stemsql.porter("voc", "norm"), "stem"))
def preprocess_porter(spark: SparkSession, data: str) -> DataFrame:
    return _switched(spark, data, "porter")


@query("preprocess_snowball", _switched_sql(stemsql.snowball("voc", "norm"), "stem"))
def preprocess_snowball(spark: SparkSession, data: str) -> DataFrame:
    return _switched(spark, data, "snowball")


@query("preprocess_lemmatizer", _switched_sql(stemsql.lemmas("voc", "norm"), "lemma"))
def preprocess_lemmatizer(spark: SparkSession, data: str) -> DataFrame:
    """The corpus' own words are the lexicon."""
    return _switched(spark, data, "lemmatizer")

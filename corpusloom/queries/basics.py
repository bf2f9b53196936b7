"""Relational queries: assembly, labels, filters, counts, samples, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import TEMPLATE_OBJECTS, TEMPLATE_SUBJECTS, TEMPLATE_VERBS
from ..functions.numbers import safe_float
from ..operators import corpus as co
from ..operators import ordered, ratelimit, registry, sampling
from ..plans.config import NORMALIZATION_CODES, STOPWORD_CODES, TOKENIZER_CODES
from ..sources import accesslog
from ..sources.files import label_from_file_name
from ..sources.generate import sentences
from ..streaming.windows import tumbling_metrics as window_metrics
from . import sql
from .base import documents, labelled, labelled_raw, query, table


@query("assemble_text", """SELECT page_id, concat_ws(' ', url,
  CASE WHEN starts_with(url, 'https') THEN html END) AS text FROM pages""")
def assemble_text(spark: SparkSession, data: str) -> DataFrame:
    pages = table(spark, data, "pages").select(
        F.col("page_id"), F.col("url").alias(" Title "),
        F.when(F.col("url").startswith("https"), F.col("html")).alias("Content"))
    named = co.normalise_header(pages)
    return named.select("page_id", co.assemble_text(named, ["content", "title", "abstract"]).alias("text"))


_SIX = {"AUTOMOBILE": "TRUE ", "BUILDING": "mostly-true", "FURNITURE": " Half-True", "MACHINERY": "pants-fire",
        "HOUSEHOLD": "unproven"}


@query("label_fold", f"""SELECT c_custkey, label FROM (
  SELECT c_custkey, CASE WHEN l IN ('true', 'mostly-true') THEN 'real'
    WHEN l IN ('half-true', 'barely-true', 'false', 'pants-fire') THEN 'fake' END AS label
  FROM (SELECT c_custkey, lower(trim(CASE c_mktsegment
    {" ".join(f"WHEN {sql.q(k)} THEN {sql.q(v)}" for k, v in _SIX.items())} END)) AS l FROM customer))
WHERE label IS NOT NULL""")
def label_fold(spark: SparkSession, data: str) -> DataFrame:
    raw = F.create_map(*[F.lit(x) for p in _SIX.items() for x in p])[F.col("c_mktsegment")]
    return table(spark, data, "customer").select("c_custkey", co.fold_label(raw).alias("label")).filter(
        F.col("label").isNotNull())


@query("label_normalise", """SELECT doc_id, CASE WHEN quality = 0 THEN 'fake' ELSE 'real' END AS label
FROM labels WHERE toxic = 0""")
def label_normalise(spark: SparkSession, data: str) -> DataFrame:
    raw = F.when(F.col("toxic") == 1, "Other").when(F.col("quality") == 0, " FAKE").otherwise("Real ")
    return co.normalise_labels(table(spark, data, "labels").select("doc_id", raw.alias("label")))


@query("drop_nulls", """SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
WHERE d.lang IS NOT NULL AND l.quality IS NOT NULL""")
def drop_nulls(spark: SparkSession, data: str) -> DataFrame:
    docs = table(spark, data, "documents").select("doc_id", "lang")
    return docs.join(table(spark, data, "labels").select("doc_id", "quality"), "doc_id", "left").na.drop()


@query("build_dataset", f"""WITH {sql.LABELLED}
SELECT doc_id, label, source, md5(clean_text) AS clean_md5, length(clean_text)::INTEGER AS n_chars FROM corpus""")
def build_dataset(spark: SparkSession, data: str) -> DataFrame:
    done = co.prepare(labelled_raw(spark, data))
    return done.select("doc_id", "label", "source", F.md5("clean_text").alias("clean_md5"),
                       F.char_length("clean_text").alias("n_chars"))


@query("validate_inputs", """WITH r AS (SELECT conv_id, turn, role, length(text) AS n FROM conversations)
SELECT conv_id, turn, CASE WHEN n < 10 THEN 'text_too_short' WHEN n > 10000 THEN 'text_too_long'
  WHEN turn < 1 OR turn > 20 THEN 'top_k' WHEN turn + 18 > 20 THEN 'min_token_length'
  WHEN role <> 'user' THEN 'tokenizer' END AS reject_reason FROM r""")
def validate_inputs(spark: SparkSession, data: str) -> DataFrame:
    turns = table(spark, data, "conversations")
    reason = co.reject_reason(
        text=F.col("text"), top_k=F.col("turn"), min_token_length=F.col("turn") + 18,
        tokenizer=F.when(F.col("role") == "user", "custom").otherwise(F.col("role")))
    return turns.select("conv_id", "turn", reason.alias("reject_reason"))


@query("join_labels", """SELECT d.doc_id, d.source, d.n_chars, l.quality, l.toxic
FROM documents d JOIN labels l ON l.doc_id = d.doc_id""")
def join_labels(spark: SparkSession, data: str) -> DataFrame:
    docs = table(spark, data, "documents").select("doc_id", "source", "n_chars")
    return docs.join(table(spark, data, "labels"), "doc_id")


@query("combine_sources", """SELECT 'documents' AS source, doc_id AS id, md5(text) AS text_md5 FROM documents
UNION ALL SELECT 'benchmark', item_id, md5(text) FROM benchmark
UNION ALL SELECT 'conversations', conv_id, md5(text) FROM conversations""")
def combine_sources(spark: SparkSession, data: str) -> DataFrame:
    def part(name: str, key: str) -> DataFrame:
        return table(spark, data, name).select(
            F.lit(name).alias("source"), F.col(key).alias("id"), F.md5("text").alias("text_md5"))

    return co.combine([part("documents", "doc_id"), part("benchmark", "item_id"), part("conversations", "conv_id")])


def _choice(words: list[str], offset: int) -> str:
    items = "[" + ", ".join(sql.q(w) for w in words) + "]"
    return f"{items}[('0x' || substr(k, {offset}, 2))::INTEGER % {len(words)} + 1]"


@query("generate_template_grid", f"""SELECT doc_id, {_choice(TEMPLATE_SUBJECTS, 1)} || ' ' || {_choice(TEMPLATE_VERBS, 3)}
  || ' ' || {_choice(TEMPLATE_OBJECTS, 5)} AS text, 'fake' AS label
FROM (SELECT doc_id, md5(doc_id::VARCHAR || ':42') AS k FROM documents)""")
def generate_template_grid(spark: SparkSession, data: str) -> DataFrame:
    return sentences(table(spark, data, "documents").select("doc_id"), "doc_id")


@query("scan_filename_label", """SELECT d.doc_id, f AS source, CASE WHEN contains(lower(f), 'fake') THEN 'fake' ELSE 'real' END AS label
FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN 'NewsFakeCOVID-19_' || source || '.csv'
  WHEN lang = 'fr' THEN 'ClaimRealCOVID-19_' || source || '.csv' ELSE 'other_' || source || '.csv' END AS f FROM documents) d
WHERE contains(lower(f), 'fake') OR contains(lower(f), 'real')""")
def scan_filename_label(spark: SparkSession, data: str) -> DataFrame:
    name = F.concat(F.when(F.col("lang") == "en", "NewsFakeCOVID-19_").when(
        F.col("lang") == "fr", "ClaimRealCOVID-19_").otherwise("other_"), "source", F.lit(".csv"))
    named = table(spark, data, "documents").select("doc_id", name.alias("source"))
    return named.withColumn("label", label_from_file_name(F.col("source"))).filter(F.col("label").isNotNull())


@query("count_by_source", """WITH c AS (SELECT d.source, CASE WHEN l.quality = 0 THEN 'fake' ELSE 'real' END AS label
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
SELECT 'source' AS kind, source AS value, count(*) AS n FROM c GROUP BY source
UNION ALL SELECT 'label', label, count(*) FROM c GROUP BY label""")
def count_by_source(spark: SparkSession, data: str) -> DataFrame:
    # one pass: count pairs, then fold the few pairs both ways
    pairs = labelled_raw(spark, data).groupBy("source", "label").agg(F.count(F.lit(1)).alias("n"))
    both = pairs.select(F.explode(F.array(
        F.struct(F.lit("source").alias("kind"), F.col("source").alias("value"), "n"),
        F.struct(F.lit("label").alias("kind"), F.col("label").alias("value"), "n"))).alias("p")).select("p.*")
    return both.groupBy("kind", "value").agg(F.sum("n").alias("n"))


_OVERVIEW = """count(*) AS documents, count(*) FILTER (label = 'fake') AS fake, count(*) FILTER (label = 'real') AS real,
  count(DISTINCT source) AS sources, round(count(*) FILTER (label = 'fake') * 100.0 / count(*), 6) AS fake_pct,
  round(count(*) FILTER (label = 'real') * 100.0 / count(*), 6) AS real_pct,
  round(avg(len(string_split(clean_text, ' '))), 6) AS avg_words"""


@query("dataset_overview_rollup", f"""WITH {sql.LABELLED}
SELECT source, {_OVERVIEW} FROM corpus GROUP BY source UNION ALL SELECT 'TOTAL', {_OVERVIEW} FROM corpus""")
def dataset_overview_rollup(spark: SparkSession, data: str) -> DataFrame:
    return co.overview(labelled(spark, data))


@query("drop_duplicates", "SELECT DISTINCT md5(text) AS text_md5, lang FROM documents")
def drop_duplicates(spark: SparkSession, data: str) -> DataFrame:
    # the digest is distinct exactly when the text is; shuffling it is cheaper
    return table(spark, data, "documents").select(F.md5("text").alias("text_md5"), "lang").dropDuplicates()


@query("run_sources", """SELECT label, to_json(list_sort(list(DISTINCT source)))::VARCHAR AS sources FROM (
  SELECT d.source, CASE WHEN l.quality = 0 THEN 'fake' ELSE 'real' END AS label
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id) GROUP BY label""")
def run_sources(spark: SparkSession, data: str) -> DataFrame:
    return registry.run_sources(labelled_raw(spark, data), ["label"])


# --- samples and splits -----------------------------------------------------------

@query("split_stratified", f"WITH {sql.LABELLED}, {sql.SPLIT} SELECT doc_id, label, part FROM parts")
def split_stratified(spark: SparkSession, data: str) -> DataFrame:
    return sampling.split(labelled(spark, data).select("doc_id", "label"))


@query("split_random", """SELECT doc_id, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS part FROM (
  SELECT doc_id, count(*) OVER () AS n, row_number() OVER (ORDER BY md5(doc_id::VARCHAR || ':42'), doc_id) AS rn FROM documents)""")
def split_random(spark: SparkSession, data: str) -> DataFrame:
    return sampling.split(table(spark, data, "documents").select("doc_id"), by=())


@query("sample_exact", """SELECT doc_id, source, lang FROM documents ORDER BY md5(doc_id::VARCHAR || ':42'), doc_id LIMIT 200""")
def sample_exact(spark: SparkSession, data: str) -> DataFrame:
    return sampling.sample_exact(table(spark, data, "documents").select("doc_id", "source", "lang"), 200)


# --- scalar functions ---------------------------------------------------------------

@query("safe_float", """SELECT event_id, CASE WHEN event_type = 'error' THEN -1.0
  WHEN event_type = 'view' THEN -1.0 ELSE value END AS number FROM events""")
def safe_number(spark: SparkSession, data: str) -> DataFrame:
    raw = (F.when(F.col("event_type") == "error", "n/a").when(F.col("event_type") == "view", "NaN")
           .otherwise(F.concat(F.lit(" "), F.col("value").cast("string"))))
    return table(spark, data, "events").select("event_id", safe_float(raw, -1.0).alias("number"))


_CODES = {"stopword_list": STOPWORD_CODES, "normalization": NORMALIZATION_CODES, "tokenizer": TOKENIZER_CODES}


@query("config_encode", """SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS stopword_code,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 0 WHEN '2' THEN 1 WHEN '3' THEN 2 WHEN '4' THEN 3 END AS norm_code,
  CASE WHEN o_totalprice < 100000 THEN 0 WHEN o_totalprice < 200000 THEN 1 ELSE 2 END AS tokenizer_code FROM orders""")
def config_encode(spark: SparkSession, data: str) -> DataFrame:
    settings = table(spark, data, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "none").when(F.col("o_orderstatus") == "O", "default")
        .when(F.col("o_orderstatus") == "P", "custom").alias("stopword_list"),
        F.element_at(F.array(*[F.lit(x) for x in (*NORMALIZATION_CODES, "other")]),
                     F.left("o_orderpriority", F.lit(1)).cast("int")).alias("normalization"),
        F.when(F.col("o_totalprice") < 100000, "custom").when(F.col("o_totalprice") < 200000, "nltk")
        .otherwise("spacy").alias("tokenizer"))
    return encode_settings(settings).select("o_orderkey", "stopword_code", "norm_code", "tokenizer_code")


def encode_settings(df: DataFrame) -> DataFrame:
    names = {"stopword_list": "stopword_code", "normalization": "norm_code", "tokenizer": "tokenizer_code"}
    return df.select("*", *[
        F.create_map(*[F.lit(x) for p in _CODES[c].items() for x in p])[F.col(c)].alias(out)
        for c, out in names.items()])


@query("settings_json", """SELECT o_orderkey, '{"max_features":' || (o_custkey + 1000) || ',"sublinear_tf":' ||
  CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END || ',"smooth_idf":' ||
  CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END || '}' AS vectorizer_settings FROM orders""")
def settings_json(spark: SparkSession, data: str) -> DataFrame:
    return table(spark, data, "orders").select("o_orderkey", F.to_json(F.struct(
        (F.col("o_custkey") + 1000).alias("max_features"), (F.col("o_orderstatus") == "F").alias("sublinear_tf"),
        (F.col("o_orderstatus") == "O").alias("smooth_idf"))).alias("vectorizer_settings"))


# --- request windows ------------------------------------------------------------------

@query("sliding_window_count", """SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts
  RANGE BETWEEN INTERVAL 60 SECOND PRECEDING AND CURRENT ROW) AS recent FROM events""")
def sliding_window_count(spark: SparkSession, data: str) -> DataFrame:
    return ratelimit.sliding_count(table(spark, data, "events")).select("event_id", "user_id", "recent")


#: Events written as lines of an access log, some of them cut off.
LINES_SQL = r"""lines AS (SELECT strftime(ts, '%Y-%m-%d %H:%M:%S,%g') || ' | INFO | POST /' || event_type
  || CASE WHEN event_id % 97 = 0 THEN '' ELSE ' status=' || CASE WHEN event_type = 'error' THEN '500' WHEN user_id % 10 = 0 THEN '429' ELSE '200' END END
  || ' client=u' || user_id || ' time_ms=' || printf('%.2f', value) AS line FROM events)"""


def _log_lines(spark: SparkSession, data: str) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "500").when(F.col("user_id") % 10 == 0, "429").otherwise("200")
    return table(spark, data, "events").select(F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" | INFO | POST /"), "event_type",
        F.when(F.col("event_id") % 97 == 0, "").otherwise(F.concat(F.lit(" status="), status)),
        F.lit(" client=u"), "user_id", F.lit(" time_ms="), F.format_string("%.2f", "value")).alias("value"))


@query("endpoint_summary", rf"""WITH {LINES_SQL},
p AS (SELECT regexp_extract(line, '\| POST (\S+) ', 1) AS path, regexp_extract(line, ' status=(\d{{3}}) ', 1)::INTEGER AS status,
  regexp_extract(line, ' time_ms=([0-9.]+)$', 1)::DOUBLE AS t FROM lines
  WHERE regexp_matches(line, '^\d{{4}}-\d{{2}}-\d{{2}} \d{{2}}:\d{{2}}:\d{{2}},\d{{3}} \| \w+ \| \w+ \S+ status=\d{{3}} client=\S+ time_ms=[0-9.]+$'))
SELECT path, status, count(*) AS requests, round(quantile_cont(t, 0.5), 6) AS median_ms,
  round(quantile_cont(t, 0.95), 6) AS p95_ms, max(t) AS max_ms FROM p GROUP BY ALL""")
def endpoint_summary(spark: SparkSession, data: str) -> DataFrame:
    return accesslog.endpoint_summary(accesslog.parse(_log_lines(spark, data)))


@query("price_quantiles", """SELECT l_returnflag AS flag, count(*) AS n, round(quantile_cont(l_extendedprice, 0.01), 6) AS q01,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS q50, round(quantile_cont(l_extendedprice, 0.99), 6) AS q99 FROM lineitem GROUP BY ALL""")
def price_quantiles(spark: SparkSession, data: str) -> DataFrame:
    found = ordered.quantiles(table(spark, data, "lineitem"), "l_extendedprice", {"q01": 0.01, "q50": 0.5, "q99": 0.99}, ["l_returnflag"])
    return found.select(F.col("l_returnflag").alias("flag"), "n", *[F.round(c, 6).alias(c) for c in ("q01", "q50", "q99")])


@query("tumbling_metrics", """SELECT strftime(time_bucket(INTERVAL 1 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
  count(*) AS n, round(sum(value), 6) AS total, max(value) AS highest FROM events GROUP BY ALL""")
def tumbling_metrics(spark: SparkSession, data: str) -> DataFrame:
    found = window_metrics(table(spark, data, "events"))
    return found.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query("rate_limit_admission")
def rate_limit_admission(spark: SparkSession, data: str) -> DataFrame:
    calls = table(spark, data, "events").select("event_id", "user_id", "ts")
    return ratelimit.admissions(calls, 3, seconds=600).select("event_id", "user_id", "admitted")

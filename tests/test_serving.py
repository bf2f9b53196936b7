"""Model families as saved pipelines, the default serving setup, versions and run logs."""

import concurrent.futures
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from corpusloom.operators import bayes, registry, terms
from corpusloom.operators.stages import CountBayes
from corpusloom.plans import experiments
from corpusloom.plans.config import REQUEST, SERVING, Features, Model, Setup, Tokens
from corpusloom.plans.preprocess import preprocess
from corpusloom.sources import runs
from corpusloom.streaming import scoring

FAMILIES = [Setup("nb", features=Features("bow"), model=Model("naive_bayes", "alpha_0.5")),
            Setup("nb_tfidf", Tokens("custom", "lemmatizer", 2), model=Model("naive_bayes", "alpha_1.0")),
            Setup("lr", Tokens("default", "porter"), Features(sublinear_tf=True)),
            *[Setup(f"poly{d}", model=Model("polynomial_lr", f"degree_{d}", d)) for d in (1, 2, 3)]]


@pytest.fixture(scope="module")
def corpus(spark):
    words = {"fake": "secret plans leaks shocking wolves children stories".split(), "real": "court reports budgets confirms analyses cities votes".split()}
    rng = np.random.default_rng(1)
    rows = []
    for i in range(60):
        label = "fake" if i % 2 else "real"
        rows.append((i, " ".join([*rng.choice(words[label], 6), *rng.choice(words["real" if i % 2 else "fake"], 2), f"number{i % 7}"]), label,
                     "train" if i < 45 else "test", f"s{i % 3}"))
    rows += [(100, "child story wolf city analysis report", "real", "train", "s0")]
    return experiments.Corpus(spark.createDataFrame(rows, "doc_id long, text string, label string, part string, source string"))


@pytest.mark.parametrize("setup", FAMILIES, ids=lambda s: s.name)
def test_saved_pipelines_predict_the_same(spark, corpus, tmp_path, setup):
    fitted = experiments.fit(setup, corpus)
    path = str(tmp_path / "model")
    runs.save_model(fitted.pipeline, path)
    again = PipelineModel.load(path)
    toks, _ = corpus.tables(setup)
    one, two = ({r.doc_id: tuple(r.probability.toArray()) for r in p.transform(toks.filter("part = 'test'")).select("doc_id", "probability").collect()}
                for p in (fitted.pipeline, again))
    assert one == two and len(one) == 15
    assert {r.doc_id: r.score for r in fitted.predictions.collect()} == {k: pytest.approx(v[1]) for k, v in one.items()}


def test_bayes_stage_equals_the_term_table(spark, corpus):
    for setup in FAMILIES[:2]:
        alpha = float(setup.model.variant.removeprefix("alpha_"))
        toks, post = corpus.tables(setup)
        train, test = (toks.filter(F.col("part") == p) for p in ("train", "test"))
        rows, asked = (post.filter(F.col("part") == p) for p in ("train", "test"))
        vocab = terms.vocabulary(rows, 5000)
        value = "tf"
        if setup.features.vectorizer == "tfidf":
            weights, value = terms.idf(vocab, train, True), "weight"
            rows, asked = terms.weigh(rows, weights), terms.weigh(asked, weights)
        model = bayes.fit(rows, vocab, (alpha,), value=value)
        want = {r.doc_id: r.p_real for r in bayes.probabilities(bayes.score(test, asked, model, train, (alpha,), value=value)).collect()}
        got = {r.doc_id: r.score for r in experiments.fit(setup, corpus).predictions.collect()}
        assert got == {k: pytest.approx(v, abs=1e-9) for k, v in want.items()} and len({round(v, 6) for v in got.values()}) > 3


def test_bayes_without_rows_of_a_class(spark):
    from pyspark.ml.linalg import Vectors

    frame = spark.createDataFrame([("real", Vectors.sparse(3, {0: 2.0})), ("real", Vectors.sparse(3, {}))], ["label", "features"])
    model = CountBayes(size=3).fit(frame)
    rows = model.transform(frame).select("probability").collect()
    assert all(math.isclose(sum(r.probability), 1.0) and r.probability[1] > 0.99 for r in rows)
    assert model.term_weights.shape == (2, 3) and len(model.coefficients) == 3


REQUESTS = [(1, "secret plan leaking wolf stories again"), (2, "short"), (3, "courts report the analyses of cities"), (None, "shocking children wolves"),
            (5, "secret plan leaking wolf stories again"), (6, None), (7, "unseen words entirely different glossary")]


def test_default_setup_serves_batch_and_stream(spark, corpus, tmp_path):
    """The default of the server lemmatises: its lexicon is stored with the model and used for both."""
    store = str(tmp_path / "store")
    info = runs.ensure_serving_model(spark, store, "Served/Default", corpus)
    assert SERVING.tokens.normalization == REQUEST.tokens.normalization == "lemmatizer" and info["version"] == 1
    assert runs.ensure_serving_model(spark, store, "Served/Default", corpus) == info
    pipeline, lexicon = runs.load_model(info["model_path"]), runs.load_lexicon(spark, info)
    names = [r.term for r in spark.read.json(store + "/artifacts/served_default/1/terms").orderBy("idx").collect()]
    requests = spark.createDataFrame(REQUESTS, scoring.REQUESTS)
    batch = scoring.score(requests, pipeline, SERVING, names, lexicon=lexicon)
    rows = sorted(map(str, batch.collect()))
    got = {r.request_id: r for r in batch.collect()}
    assert got[1].processed_text == "secret plan leaking wolf story" and got[1].prediction == "fake"  # wolf and story are in the lexicon
    assert got[3].processed_text.startswith("court report") and got[3].prediction == "real"
    assert got[2].reject_reason == "text_too_short" and got[6].reject_reason and got[6].prediction is None
    assert got[1].top_contributing_features and got[None].prediction == "fake"
    assert (got[1].processed_text, got[1].confidence) == (got[5].processed_text, got[5].confidence)
    requests.repartition(3).write.json(str(tmp_path / "in"))
    for _ in range(2):  # a second start finds nothing new
        scoring.start_scoring(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), pipeline, SERVING, names, lexicon).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out")).select(*batch.columns)
    assert sorted(map(str, streamed.collect())) == rows
    with pytest.raises(ValueError):
        scoring.score(requests, pipeline, SERVING)
    with pytest.raises(ValueError):
        scoring.score(spark.readStream.schema(scoring.REQUESTS).json(str(tmp_path / "in")), pipeline, SERVING, lexicon=lexicon)


def test_lemmatiser_without_keys(spark):
    setup = Setup("x", Tokens("none", "lemmatizer"))
    rows = [(1, "cities and city", "a"), (1, "cats", "b"), (None, "cities", "c"), (None, "", "d"), (2, " ", "e"), (1, "cities and city", "f")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _key string")
    lexicon = spark.createDataFrame([("city",), ("cat",), ("and",)], "term string")
    got = {r._key2: r.processed_text for r in preprocess(frame.withColumnRenamed("_key", "_key2"), setup, lexicon=lexicon).collect()}
    assert got == {"a": "city and city", "b": "cat", "c": "city", "d": "empty", "e": "empty", "f": "city and city"}


def test_writers_that_meet_get_different_numbers(spark, tmp_path):
    store, scores = str(tmp_path / "s"), {"weighted_f1": 0.123456789012, "accuracy": 0.5, "roc_auc": 0.5}
    with concurrent.futures.ThreadPoolExecutor(10) as pool:
        numbers = list(pool.map(lambda i: runs.append_version(spark, store, "A/b", f"r{i}", scores), range(10)))
    assert sorted(numbers) == list(range(1, 11))
    rows = runs.read_versions(spark, store).collect()
    assert len(rows) == 10 and {r.weighted_f1 for r in rows} == {0.123456789012} and {r.model_name for r in rows} == {"A/b"}
    assert runs.append_version(spark, store, "other", "x", scores) == 1


def test_groups_leave_runs_and_models(spark, corpus, tmp_path):
    store = str(tmp_path / "g")
    rows = experiments.run_group(FAMILIES[:3], corpus, store, "models", register=True)
    assert rows.count() == 3 and {"f1_fake", "precision_real", "support_fake"} <= set(rows.columns)
    logged = {r.run_name: r for r in runs.read_runs(spark, store).collect()}
    assert set(logged) == {"nb", "nb_tfidf", "lr"} and len({r.run_id for r in logged.values()}) == 3
    assert logged["lr"].params["normalization"] == "porter" and logged["lr"].params["n_train"] == "46" and logged["lr"].params["n_test"] == "15"
    assert logged["lr"].params["sources"] == '["s0","s1","s2"]'
    assert {"accuracy", "weighted_f1", "roc_auc", "recall_fake"} <= set(logged["nb"].metrics) and "max_features" not in logged["nb"].metrics
    versions = runs.staged_versions(spark, store).collect()
    assert {r.model_name for r in versions} == {"models/naive_bayes", "models/logistic_regression"}
    for r in versions:
        assert runs.load_model(runs.model_path(store, r.model_name, r.version)).stages
    report = registry.performance_report(runs.staged_versions(spark, store), runs.run_metrics(runs.read_runs(spark, store)), 2).collect()
    assert [sum(r.part == p for r in report) for p in ("serving", "version", "run")] == [2, 2, 2]

import datetime
import pathlib
from collections import defaultdict, deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.tokens import tokenize
from corpusloom.operators import corpus, ratelimit, terms
from corpusloom.plans import experiments
from corpusloom.plans.config import Features, Model, Setup, Tokens
from corpusloom.sources import accesslog, files, generate, lake, runs
from corpusloom.streaming import limiter, scoring, windows


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("collections")

    def put(name, data, encoding="utf-8"):
        path = base / "datasets" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data.encode(encoding))

    put("covid19-fakenews/NewsFakeCOVID-19.csv", ' Title ,Content,other\n"A ""q""","line1\nline2",x\n,only,y\n,,z\n')
    put("covid19-fakenews/sub/ClaimRealCOVID-19_5.csv", "title\ncafé au lait\n", "latin-1")
    put("covid19-fakenews/NewsFakeCOVID-19_tweets.csv", "index,tweet_id\n1,2\n")
    put("fakenewsnet/BuzzFeed_fake_news_content.csv", "id,title,text\n1,T,body\n")
    put("isotfakenews/True.csv", "title,text,subject,date\nN,news text,world,d\n")
    put("liar-dataset/train.tsv", "1.json\tmostly-true\tsays \"x\tsub\n2.json\tweird\ty\ts\n3.json\tpants-fire\t  \ts\n4.json\tFALSE\tz claim\ts\n")
    put("generated_fakenews/fake_news_dataset.csv", "text,label\nArmy bans x, FAKE \nq,maybe\n")
    return str(base)


def test_collections(spark, root):
    rows = {(r.text, r.label, r.source) for r in files.load_all(spark, root, include_generated=True).collect()}
    assert rows == {
        ('A "q" line1\nline2', "fake", "NewsFakeCOVID-19.csv"), ("only", "fake", "NewsFakeCOVID-19.csv"),
        ("café au lait", "real", "ClaimRealCOVID-19_5.csv"), ("T body", "fake", "fakenewsnet-BuzzFeed"),
        ("N news text world", "real", "isotfakenews"), ('says "x', "real", "liar-dataset"),
        ("z claim", "fake", "liar-dataset"), ("Army bans x", "fake", "generated_fakenews")}
    assert files.load_all(spark, root, sample=3).count() == 3
    empty = files.load_all(spark, root + "/nothing")
    assert empty.columns == ["text", "label", "source"]
    with pytest.raises(ValueError):
        corpus.require_rows(empty)


def test_one_scan_reads_many_files(spark, tmp_path):
    """Headers, encodings, widths and line breaks differ by file; nothing depends on their number."""
    base, want = tmp_path / "datasets" / "covid19-fakenews", set()
    base.mkdir(parents=True)
    for i in range(60):
        label, name = ("fake", f"NewsFakeCOVID-19 {i}.csv") if i % 2 else ("real", f"ClaimRealCOVID-19_{i}.csv")
        kind = i % 5
        body = {0: f' Title ,x,CONTENT\n"t, {i}",1,c{i}\n,2,only{i}\n', 1: f'abstract\n"line1 {i}\nline2"\n"""q"""\n', 2: f"newstitle,other\ncafé {i},y\n",
                3: f"other,thing\na,b{i}\n", 4: f"a,b,c,d,e,f,title\n1,2,3,4,5,6,wide {i}\nshort\n"}[kind]
        (base / name).write_bytes(body.encode("latin-1" if kind == 2 and i % 3 else "utf-8"))
        want |= {(t, label, name) for t in {0: (f"t, {i} c{i}", f"only{i}"), 1: (f"line1 {i}\nline2", '"q"'), 2: (f"café {i}",), 3: (), 4: (f"wide {i}",)}[kind]}
    (base / "empty COVID-19 fake.csv").write_text("")
    (base / "no label COVID-19.csv").write_text("title\nx\n")
    assert {tuple(r) for r in files.load_health(spark, str(tmp_path)).collect()} == want
    rows = files.read_tables(spark, str(base), {"title"}, "ClaimReal*_0.csv").collect()
    assert [(r.file, r.names, r.text) for r in rows] == [("ClaimRealCOVID-19_0.csv", ["title", "x", "content"], "t, 0"), ("ClaimRealCOVID-19_0.csv", ["title", "x", "content"], "")]


def test_a_file_in_many_splits(spark, tmp_path):
    path = tmp_path / "News.csv"
    path.write_text("id,title\n" + "".join(f"{i},text number {i}\n" for i in range(20000)))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        rows = files.read_tables(spark, str(path), {"title"})
        assert spark.read.csv(str(path)).rdd.getNumPartitions() > 1  # so is the scan of the file
        assert {r.text for r in rows.collect()} == {f"text number {i}" for i in range(20000)} and rows.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_generator(spark, tmp_path):
    assert generate.grid(spark).distinct().count() == 216
    made = generate.generate(spark, 500)
    assert made.count() == made.distinct().count() <= 216
    files.write_csv(made, str(tmp_path / "g"))
    assert spark.read.option("header", True).csv(str(tmp_path / "g")).count() == made.count()


def test_lake(spark, tmp_path, root):
    base = str(tmp_path / "lake")
    lake.upload_raw(spark, base, "news", root + "/datasets/isotfakenews", {"owner": "x"}, "v1")
    rows = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    lake.upload_processed(base, "news", rows, vocabulary=rows.select("text"), version="v2")
    lake.upload_processed(base, "news", rows)
    lake.upload_embeddings(base, "w2v", "1", rows, {"dim": 2})
    assert lake.list_versions(spark, base, "processed", "news") == ["latest", "v2"]
    assert lake.list_versions(spark, base, "raw") == ["news"]
    assert lake.list_versions(spark, base, "embeddings", model="w2v") == ["1"]
    assert lake.fetch_for_training(spark, base, "news").count() == 1
    assert lake.fetch_for_training(spark, base, "news", "v1", "raw").first().file == "True.csv"
    for kwargs in ({"layer": "bad", "dataset": "news"}, {"layer": "embeddings"}, {"layer": "raw"}):
        with pytest.raises(ValueError):
            lake.fetch_for_training(spark, base, **kwargs)


def test_access_log(spark, tmp_path):
    (tmp_path / "app.log").write_text(
        "2026-05-06 01:56:43,390 | INFO | GET /health status=200 client=127.0.0.1 time_ms=0.358\n"
        "2026-05-06 01:56:44,390 | INFO | GET /health status=200 client=127.0.0.1 time_ms=0.4\n"
        "2026-05-06 01:56:43,389 | INFO | Loaded model\n")
    log = accesslog.read(spark, str(tmp_path))
    assert log.filter("matched").count() == 2 and log.filter("not matched").count() == 1
    row = accesslog.endpoint_summary(log).first()
    assert (row.path, row.status, row.requests, row.max_ms) == ("/health", 200, 2, 0.4)
    assert row.median_ms == pytest.approx(0.379)


def test_validation(spark):
    df = spark.createDataFrame([("short", 5, ["x" * 10]), ("x" * 20, 25, ["x" * 10]), ("x" * 20, 5, ["x" * 10] * 101),
                                ("x" * 20, 5, ["ok" * 10]), ("x" * 10001, 5, ["x" * 10])], "t string, k int, b array<string>")
    reason = corpus.reject_reason(text=F.col("t"), top_k=F.col("k"), batch=F.col("b"))
    assert [r.r for r in df.select(reason.alias("r")).collect()] == [
        "text_too_short", "top_k", "batch_size", None, "text_too_long"]
    ok, bad = corpus.split_valid(df, reason)
    assert ok.count() == 1 and bad.count() == 4


def replay(rows, limit, span):
    logs, out = defaultdict(deque), {}
    for user, i, t in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        log = logs[user]
        while log and t - log[0] > span:
            log.popleft()
        out[i] = len(log) < limit
        if out[i]:
            log.append(t)
    return out


def _events(spark, n=400):
    rng = np.random.default_rng(4)
    start = datetime.datetime(2024, 1, 1)
    secs = np.cumsum(rng.choice([0, 1, 5, 20, 60, 61, 200], n))
    rows = [(int(rng.choice([1, 1, 1, 2, 3])), i, int(s)) for i, s in enumerate(secs)]
    df = spark.createDataFrame([(i, u, start + datetime.timedelta(seconds=s)) for u, i, s in rows],
                               "event_id long, user_id long, ts timestamp_ntz")
    return rows, df


def test_rate_limit_batch_and_stream(spark, tmp_path):
    rows, df = _events(spark)
    want = replay(rows, 3, 60)
    got = {r.event_id: r.admitted for r in ratelimit.admissions(df, 3).collect()}
    assert got == want and not all(want.values())
    src = str(tmp_path / "in")
    df.filter("event_id < 200").coalesce(1).write.parquet(src)
    df.filter("event_id >= 200").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 10).parquet(src)
    q = (limiter.limit_stream(stream, 3).writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    streamed = {r.event_id: r.admitted for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert streamed == want


def test_sliding_count_crosses_blocks(spark):
    rows, df = _events(spark)
    got = {r.event_id: r.recent for r in ratelimit.sliding_count(df, block=60).collect()}
    for u, i, t in rows:
        assert got[i] == sum(1 for v, _, s in rows if v == u and t - 60 <= s <= t)


def test_window_metrics_stream_equals_batch(spark, tiny, tmp_path):
    events = spark.read.parquet(f"{tiny}/events.parquet")
    batch = {tuple(r) for r in windows.tumbling_metrics(events).collect()}
    src = str(tmp_path / "ev")
    events.orderBy("ts").coalesce(1).write.parquet(src)
    stream = windows.tumbling_metrics(spark.readStream.schema(events.schema).parquet(src), lateness="1 minute")
    q = (stream.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "o"))
         .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    q.awaitTermination()
    streamed = {tuple(r) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert streamed <= batch and len(batch) - len(streamed) <= 10  # the last windows are still open


@pytest.fixture(scope="module")
def small_corpus(spark):
    rows = [(i, f"{'secret shocking plan leaks' if i % 2 else 'court report confirms budget'} number {i} today",
             "fake" if i % 2 else "real", "train" if i < 40 else "test") for i in range(50)]
    return experiments.Corpus(spark.createDataFrame(rows, "doc_id long, text string, label string, part string"))


def test_experiments_and_registry(spark, small_corpus, tmp_path):
    configs = [Setup("nb", features=Features("bow"), model=Model("naive_bayes")), Setup("lr", features=Features(sublinear_tf=True)),
               Setup("poly", model=Model("polynomial_lr"))]
    rows = experiments.run_group(configs, small_corpus).collect()
    assert [r.name for r in sorted(rows, key=lambda r: r.run_order)] == ["nb", "lr", "poly"]
    assert all(r.accuracy == 1.0 and r.roc_auc == 1.0 for r in rows)
    with pytest.raises(ValueError):
        experiments.fit(Setup("bad", model=Model("tree")), small_corpus)
    store = str(tmp_path / "store")
    info = runs.ensure_serving_model(spark, store, "Served/LR", small_corpus, Setup("boot"))
    assert info["version"] == 1 and info["stage"] == "Production"
    assert runs.ensure_serving_model(spark, store, "Served/LR", small_corpus, Setup("boot")) == info
    assert pathlib.Path(info["model_path"]).exists()
    assert runs.load_model(info["model_path"]).stages[-1].numFeatures > 0
    assert runs.run_metrics(runs.read_runs(spark, store)).first().accuracy == 1.0
    runs.append_version(spark, store, "Served/LR", "r2", {"weighted_f1": 0.5, "accuracy": 0.5, "roc_auc": 0.5})
    assert {r.version: r.stage for r in runs.staged_versions(spark, store).collect()} == {1: "Production", 2: "Staging"}
    runs.write_artifacts(str(tmp_path / "art"), report=experiments.run_group(configs[:1], small_corpus))
    assert spark.read.json(str(tmp_path / "art" / "report")).count() == 1


def test_stream_scoring_equals_batch(spark, small_corpus, tmp_path):
    config = Setup("s", Tokens("custom", "porter", 2))
    fitted = experiments.fit(config, small_corpus)
    requests = spark.createDataFrame([(1, "secret plan leaks today again"), (2, "short"), (3, "court confirms the budget")],
                                     scoring.REQUESTS)
    batch = {r.request_id: r for r in scoring.score(requests, fitted.pipeline, config, fitted.names).collect()}
    assert batch[1].prediction == "fake" and batch[3].prediction == "real"
    assert batch[2].reject_reason == "text_too_short" and batch[2].prediction is None
    top = batch[1].top_contributing_features
    assert top and abs(top[0].contribution) == max(abs(t.contribution) for t in top)
    requests.coalesce(1).write.json(str(tmp_path / "in"))
    scoring.start_scoring(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"),
                          fitted.pipeline, config, fitted.names).awaitTermination()
    streamed = {r.request_id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert {k: (r.prediction, r.confidence) for k, r in streamed.items()} == {
        k: (r.prediction, r.confidence) for k, r in batch.items()}

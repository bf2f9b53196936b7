import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import bayes, embed, langmodel, linear, metrics, projection, registry, retrieve, sampling, terms
from corpusloom.operators.vectors import apply_stages, fit_vectoriser
from corpusloom.queries import QUERIES, base, learning

DOCS = [(1, "fake", "a b a c".split()), (2, "fake", "a b b".split()), (3, "real", "c d e".split()),
        (4, "real", "d e a".split()), (5, "real", "d d".split())]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, label string, tokens array<string>").cache()


def test_tfidf_rows_are_unit(spark, docs):
    w = terms.tfidf(terms.postings(docs, keep=["label"]), docs, True)
    norms = [r.n for r in w.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()]
    assert np.allclose(norms, 1.0)
    got = {(r.doc_id, r.term): r.weight for r in w.collect()}
    idf = {t: math.log(6 / (1 + d)) + 1 for t, d in (("d", 2), ("e", 2))}
    idf = {"c": math.log(6 / 3) + 1, "d": math.log(6 / 4) + 1, "e": math.log(6 / 3) + 1}
    norm = math.sqrt(sum(v * v for v in idf.values()))
    assert got[(3, "d")] == pytest.approx(idf["d"] / norm)


def test_naive_bayes_by_hand(spark, docs):
    post = terms.postings(docs, keep=["label"])
    vocab = terms.vocabulary(post, 100)
    model = bayes.fit(post, vocab, (1.0,), value="tf")
    lp = {r.term: (r.lp_0_fake, r.lp_0_real) for r in model.collect()}
    assert lp["a"][0] == pytest.approx(math.log((3 + 1) / (7 + 5) + 1e-12))
    assert lp["e"][0] == pytest.approx(math.log(1 / 12 + 1e-12))
    out = {r.doc_id: r for r in bayes.score(docs, post, model, docs, (1.0,), value="tf").collect()}
    want = math.log(0.4 + 1e-12) + 3 * 0 + sum(c * lp[t][0] for t, c in Counter(DOCS[0][2]).items())
    assert out[1].score_fake == pytest.approx(want) and out[1].prediction == "fake" and out[5].prediction == "real"


def brute_kn(train, n):
    counts, ctx, followers, before, vocab = (defaultdict(Counter), defaultdict(Counter), defaultdict(set), defaultdict(set), {"</s>"})
    for toks in train:
        vocab |= set(toks)
        for k in range(1, n + 1):
            p = ["<s>"] * (k - 1) + toks + ["</s>"]
            for i in range(len(p) - k + 1):
                g = tuple(p[i:i + k])
                counts[k][g] += 1
                if k > 1:
                    ctx[k][g[:-1]] += 1
                    followers[g[:-1]].add(g[-1])
                if k == 2:
                    before[g[1]].add(g[0])

    def prob(k, h, w):
        if k == 1:
            p = len(before[w]) / len(counts[2]) if counts[2] else 0
            return p or 1 / len(vocab)
        h = h[-(k - 1):]
        if not ctx[k][h]:
            return prob(k - 1, h[1:], w)
        p = max(counts[k][h + (w,)] - 0.75, 0) / ctx[k][h] + 0.75 * len(followers[h]) / ctx[k][h] * prob(k - 1, h[1:], w)
        return p if p > 0 else 1 / len(vocab)

    def ppl(toks):
        p = ["<s>"] * (n - 1) + toks + ["</s>"]
        grams = [tuple(p[i:i + n]) for i in range(len(p) - n + 1)]
        return math.exp(-sum(math.log(prob(n, g[:-1], g[-1]) + 1e-12) for g in grams) / len(grams))

    return ppl


@pytest.mark.parametrize("order", [1, 2, 3])
def test_kneser_ney_matches_recursion(spark, docs, order):
    test = [(10, ["a", "b", "c"]), (11, ["d", "zz", "e"]), (12, ["q"])]
    asked = spark.createDataFrame([*test, (13, [])], "doc_id long, tokens array<string>")
    got = {(r.doc_id, r.label): r.perplexity for r in langmodel.perplexity(langmodel.fit(docs), asked, order).collect()}
    for label in ("fake", "real"):
        ppl = brute_kn([t for _, lab, t in DOCS if lab == label], order)
        for i, toks in test:
            assert got[(i, label)] == pytest.approx(ppl(toks), rel=1e-9)
        assert got[(13, label)] == math.inf


def test_metrics_and_auc(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "real" if rng.random() < 0.6 else "fake", float(round(rng.random(), 1))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, label string, score double").withColumn(
        "prediction", F.when(F.col("score") > 0.5, "real").otherwise("fake"))
    pos = [s for _, y, s in rows if y == "real"]
    neg = [s for _, y, s in rows if y == "fake"]
    mann = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert metrics.auc(metrics.roc_points(df)).first().auc == pytest.approx(mann, abs=1e-6)
    acc = sum((s > 0.5) == (y == "real") for _, y, s in rows) / 80
    got = metrics.evaluate(df).first()
    assert got.accuracy == pytest.approx(acc, abs=1e-6) and got.recall == pytest.approx(acc, abs=1e-6)
    assert metrics.evaluate(df.limit(0).withColumn("prediction", F.lit("fake"))).first().accuracy == 0.0


def test_split_and_sample_match_sorting(spark):
    import hashlib

    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "fake").otherwise("real").alias("label"))
    key = lambda i: hashlib.md5(f"{i}:42".encode()).hexdigest()
    got = {r.doc_id for r in sampling.split(df).filter("part = 'test'").collect()}
    want = set()
    for group in ([i for i in range(3000) if i % 10 == 0], [i for i in range(3000) if i % 10]):
        want |= set(sorted(group, key=key)[:math.ceil(0.2 * len(group))])
    assert got == want
    assert {r.doc_id for r in sampling.sample_exact(df, 37).collect()} == set(sorted(range(3000), key=key)[:37])
    assert sampling.sample_exact(df, 5000).count() == 3000


def _weights(spark, n=60, seed=3):
    rng = np.random.default_rng(seed)
    vocab = [f"t{i}" for i in range(40)]
    rows = [(d, str(rng.choice(vocab, p=np.arange(40, 0, -1) / 820)), 1) for d in range(n) for _ in range(12)]
    rows += [(n + j, t, 1) for j in range(5) for t in ("t0", "t1", "t30")]  # exact copies
    post = spark.createDataFrame(rows, "doc_id long, term string, n int").groupBy("doc_id", "term").agg(F.count("*").alias("tf"))
    docs = post.select("doc_id").distinct()
    return terms.tfidf(post, docs).cache()


def test_retrieval_pairs_and_centrality_match_brute_force(spark):
    w = _weights(spark)
    vec = defaultdict(dict)
    for r in w.collect():
        vec[r.doc_id][r.term] = r.weight
    dot = lambda a, b: sum(x * b.get(t, 0.0) for t, x in a.items())
    queries = w.filter("doc_id < 6").select(F.col("doc_id").alias("query_id"), "term", "weight")
    got = defaultdict(list)
    for r in retrieve.top_k(queries, w, 4, seeds=2).orderBy("rank").collect():
        got[r.query_id].append((r.doc_id, r.cosine))
    for q in range(6):
        want = sorted(((d, round(dot(vec[q], v), 6)) for d, v in vec.items()), key=lambda x: (-x[1], x[0]))[:4]
        assert [d for d, _ in got[q]] == [d for d, _ in want]
    reps = {}
    tf = defaultdict(dict)
    for r in w.collect():
        tf[r.doc_id][r.term] = r.tf
    for d in sorted(tf):
        reps.setdefault(tuple(sorted(tf[d].items())), d)
    ids = sorted(reps.values())
    want = {(a, b) for a in ids for b in ids if a < b and round(dot(vec[a], vec[b]), 6) >= 0.6}
    pairs = retrieve.similar_pairs(w, 0.6).collect()
    assert {(r.doc_a, r.doc_b) for r in pairs} == want and want
    best = retrieve.centrality(w, w.select("doc_id").distinct(), 3).collect()
    means = sorted(((round(sum(dot(vec[a], vec[b]) for b in vec) / len(vec), 6), -a) for a in vec), reverse=True)[:3]
    assert [r.doc_id for r in best] == [-a for _, a in means]


def test_corpus_centrality_keeps_a_row_a_document(spark, tmp_path):
    """Repeated and null ids are one document each; no row a term is kept or sorted by document."""
    texts = [(1, "sun moon sun"), (2, "moon bread"), (2, "bread it's"), (None, "sun salt"), (None, "salt rice"), (3, None), (4, ""), (5, "rice rice milk")]
    rows = spark.createDataFrame(texts, "doc_id long, text string").withColumn("source", F.lit("s"))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["corpus_centrality"](spark, str(tmp_path))
    kept = {name: frame for (_, data, name), frame in base._shared.items() if data == str(tmp_path)}
    assert set(kept) == {"document_terms", "corpus_idf"} and kept["document_terms"].count() == 4
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    split = rows.select("doc_id", F.split("text", " ").alias("tokens")).filter("text <> ''")
    post = terms.postings(split)
    idfs = terms.idf(terms.vocabulary(post), rows, False)
    want = terms.weigh(post, idfs)
    found = terms.weigh_packed(kept["document_terms"], kept["corpus_idf"])
    as_set = lambda df: {(r.doc_id, r.term, r.tf, round(r.weight, 12)) for r in df.collect()}
    assert as_set(found) == as_set(want) and found.count() == want.count() and as_set(terms.weigh(base.document_postings(spark, str(tmp_path)), idfs)) == as_set(want)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in retrieve.centrality(want, rows, 10).collect()]


def test_split_joins_a_row_a_document(spark, tmp_path):
    """Repeated ids count as often as they stand in the part, as rows a term did; only documents are joined."""
    texts = [(i, f"sun moon w{i % 4} w{i % 4}") for i in range(20)] + [(3, "moon bread"), (4, None), (None, "sun")]
    spark.createDataFrame(texts, "doc_id long, text string").withColumn("source", F.lit("s")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(20)] + [(3, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    frames = learning.split_frames(spark, str(tmp_path))
    kept = {name: frame for (_, data, name), frame in base._shared.items() if data == str(tmp_path)}
    post = terms.postings(kept["labelled"], keep=["label"])
    as_rows = lambda df: Counter((r.doc_id, r.label, r.term, r.tf) for r in df.collect())
    assert kept["labelled_terms"].count() == post.select("doc_id", "label").distinct().count()
    assert as_rows(base.labelled_postings(spark, str(tmp_path))) == as_rows(post)
    for part in ("train", "test"):
        assert as_rows(frames[part]) == as_rows(post.join(frames[f"{part}_docs"].select("doc_id"), "doc_id"))


def test_similar_pairs_over_many_blocks(spark, monkeypatch):
    """Every pair shares terms, few are near: none is lost or listed twice where blocks and steps are small."""
    monkeypatch.setattr(retrieve, "BLOCK", 9)
    monkeypatch.setattr(retrieve, "STEP", 4)
    rng = np.random.default_rng(3)
    tf = rng.integers(1, 5, (40, 30)) * (rng.random((40, 30)) < 0.5)
    tf[20:25] = tf[:5]
    tf[25:30] = tf[5:10]
    tf[25:30, 0] += 1
    unit = tf / np.linalg.norm(tf, axis=1, keepdims=True)
    rows = [(d, f"t{t}", int(tf[d, t]), float(unit[d, t])) for d in range(40) for t in range(30) if tf[d, t]]
    w = spark.createDataFrame(rows, "doc_id long, term string, tf long, weight double")
    reps = [d for d in range(40) if not 20 <= d < 25]
    want = {(a, b, 1 + (a < 5), 1 + (b < 5), round(float(unit[a] @ unit[b]), 6)) for a in reps for b in reps if a < b and unit[a] @ unit[b] >= 0.7}
    got = retrieve.similar_pairs(w, 0.7).select("doc_a", "doc_b", "copies_a", "copies_b", "cosine").collect()
    assert len(want) >= 5 and len(got) == len(want)
    assert {tuple(r)[:4] for r in got} == {x[:4] for x in want}


def test_promotion_fold(spark):
    df = spark.createDataFrame([("m", i + 1, f) for i, f in enumerate([0.80, 0.805, 0.82, 0.81])], "model_name string, version int, f1 double")
    stages = {r.version: r.stage for r in registry.promotions(df).collect()}
    assert stages == {1: "Archived", 2: "Staging", 3: "Production", 4: "Staging"}
    assert registry.serving_version(registry.promotions(df)).first().version == 3


@pytest.mark.parametrize("head", [10000, 3])
def test_promotion_fold_many_blocks(spark, head):
    rng = np.random.default_rng(5)
    f1 = [float(x) for x in rng.random(500)] + [0.5, 0.5 + 1e-9, 2.0, 2.0 + 0.01, 2.0 + 0.0199999]
    want, champ = [], -1.0
    for i, f in enumerate(f1):
        if not want or f >= champ + 0.01:
            want.append(i)
            champ = f
    df = spark.createDataFrame([("m", i, f) for i, f in enumerate(f1)] + [("one", 7, 0.1)], "model_name string, version int, f1 double")
    recs = registry.records(df, block=7)
    best, keep = -1.0, []
    for i, f in enumerate(f1):
        if f > best:
            keep.append(i)
            best = f
    assert sorted(r.version for r in recs.filter("model_name = 'm'").collect()) == keep
    rows = registry.promotions(df, head=head).collect()
    assert sorted(r.version for r in rows if r.stage != "Staging" and r.model_name == "m") == want
    assert [r.version for r in rows if r.stage == "Production" and r.model_name == "m"] == want[-1:]
    assert len(rows) == len(f1) + 1 and next(r.stage for r in rows if r.model_name == "one") == "Production"


def test_logistic_optimum_and_pca(spark, docs):
    post = terms.postings(docs, keep=["label"])
    stages, names = fit_vectoriser(post, docs, 100)
    rows = apply_stages(docs, stages, ["doc_id", "label", "features"]).cache()
    model = linear.fit_logistic(rows, "l2", True, max_iter=500, tol=1e-12)
    x = np.array([r.features.toArray() for r in rows.orderBy("doc_id").collect()])
    y = np.array([1.0 if lab == "real" else 0.0 for _, lab, _ in DOCS])
    sw = np.where(y == 1, 5 / (2 * 3), 5 / (2 * 2))
    p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    assert np.abs(x.T @ (sw * (p - y)) + model.coefficients.toArray()).max() < 1e-4
    weights = {(r.doc_id, r.term): r.weight for r in terms.tfidf(post, docs, max_features=100).collect()}
    assert x[2][names.index("d")] == pytest.approx(weights[(3, "d")])
    pca = projection.fit_pca(rows, len(names))
    centred = x - x.mean(axis=0)
    values = np.linalg.svd(centred)[1] ** 2
    assert np.allclose(pca.explained_variance_ratio, values[:2] / values.sum(), atol=1e-8)


def test_words_are_numbered_without_a_row_a_word(spark):
    rows = [(1, "fake", ["b", "a", "b"]), (1, "fake", ["c", None]), (2, "real", []), (3, "real", None), (None, "real", ["a"]), (None, "fake", ["x", "a"])]
    docs = spark.createDataFrame(rows, "doc_id long, label string, tokens array<string>")
    words = spark.createDataFrame([("a", 3), ("b", 4), ("c", 5)], "word string, id long")
    got = langmodel._numbered(docs, words, "doc_id", "tokens", ["label"])
    assert "FlatMapCoGroupsInArrow" in got._jdf.queryExecution().optimizedPlan().toString()
    # rows of one key are one document, place by place
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, "fake", [4, 5, 0, 3, 4]), (None, "real", [3]), (None, "fake", [0, 3])]))
    model = langmodel.fit(docs.filter("doc_id = 1 or label = 'real'"))
    asked = spark.createDataFrame([("<s>", "<s>", "a"), ("b", "x", "</s>"), ("x", "y", "b")], "w1 string, w2 string, w3 string")
    found = langmodel.trigram_probability(model, asked)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.label, r.w1, r.w2, r.w3) for r in found.collect()} == {(c, *t) for c in ("fake", "real") for t in map(tuple, asked.collect())}


def test_cbow_related_words_are_nearer(spark):
    rng = np.random.default_rng(0)
    groups = [["sun", "moon", "star", "sky"], ["bread", "milk", "rice", "salt"]]
    rows = [(i, [str(w) for w in rng.choice(groups[i % 2], 12)]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>").repartition(2)
    v = {r.word: np.array(r.vector) for r in embed.cbow(df, size=16, epochs=8, rate=0.1).collect()}
    cos = lambda a, b: v[a] @ v[b] / np.linalg.norm(v[a]) / np.linalg.norm(v[b])
    assert cos("sun", "moon") > cos("sun", "bread") and cos("milk", "rice") > cos("milk", "star")


def test_skip_gram_chunks_hold_each_word_once_and_every_pair(monkeypatch):
    rng = np.random.default_rng(3)
    words, size, window, negative, step = 9, 4, 3, 5, 0.05
    flat, doc = rng.integers(0, words, 3 * embed.CHUNK + 5), np.sort(rng.integers(0, 6, 3 * embed.CHUNK + 5))
    a, b = rng.standard_normal((2, words, size)).astype(np.float32)
    cum = np.cumsum(np.bincount(flat, minlength=words) ** 0.75)
    cum /= cum[-1]
    draws = np.random.default_rng(5)
    reach = draws.integers(1, window + 1, size=len(flat))
    drawn = np.searchsorted(cum, draws.random((-(-len(flat) // embed.CHUNK), embed.DRAWN)))
    x, y, seen = a.astype(float), b.astype(float), np.zeros((2, words))
    for start in range(0, len(flat), embed.CHUNK):
        to_x, to_y = np.zeros_like(x), np.zeros_like(y)
        for i in range(start, min(start + embed.CHUNK, len(flat))):
            for j in range(max(0, i - reach[i]), min(len(flat), i + reach[i] + 1)):
                if j == i or doc[i] != doc[j]:
                    continue
                negatives = [(k, negative / embed.DRAWN, 0.0) for k in drawn[start // embed.CHUNK] if k != flat[j]]
                for k, share, truth in [(flat[j], 1.0, 1.0), *negatives]:
                    error = step * share * (truth - 1 / (1 + np.exp(-x[flat[i]] @ y[k])))
                    to_x[flat[i]] += error * y[k]
                    to_y[k] += error * x[flat[i]]
                    seen[1, k] += share
                seen[0, flat[i]] += 1
        for table, moves in ((x, to_x), (y, to_y)):
            length = np.linalg.norm(moves, axis=1, keepdims=True)
            table += moves * np.minimum(1, embed.LONGEST / np.maximum(length, 1e-30))
    move, met = embed._move, []
    monkeypatch.setattr(embed, "_move", lambda table, rows, *rest: (met.append(rows), move(table, rows, *rest)))
    got = np.zeros((2, words))
    embed._pairs(flat, doc, a, b, got, cum, window, negative, step, np.random.default_rng(5))
    assert np.allclose(a, x, atol=1e-4) and np.allclose(b, y, atol=1e-4) and np.allclose(got, seen, rtol=1e-4)
    assert met and all(len(set(rows.tolist())) == len(rows) for rows in met)  # words repeated in a chunk cost no more rows


def test_skip_gram_related_words_are_nearer(spark):
    rng = np.random.default_rng(0)
    groups = [["sun", "moon", "star", "sky"], ["bread", "milk", "rice", "salt"]]
    rows = [(i, [str(w) for w in rng.choice(groups[i % 2], 12)]) for i in range(300)] + [(300, None), (301, []), (None, ["sun", "rare"])]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>").repartition(2)
    v = {r.word: np.array(r.vector) for r in embed.skip_gram(df, size=16, epochs=8, rate=0.1).collect()}
    cos = lambda a, b: v[a] @ v[b] / np.linalg.norm(v[a]) / np.linalg.norm(v[b])
    assert set(v) == {w for g in groups for w in g} and cos("sun", "moon") > cos("sun", "bread") and cos("milk", "rice") > cos("milk", "star")


@pytest.mark.parametrize("mode", ["skip_gram", "cbow"])
def test_epochs_and_waves_leave_nothing_behind(spark, monkeypatch, mode):
    from pathlib import Path

    from corpusloom.session import checkpoint_dir

    kept = Path(checkpoint_dir(spark).removeprefix("file:"))
    rng = np.random.default_rng(1)
    rows = [(i, [f"w{k}" for k in rng.integers(0, 30, 12)]) for i in range(120)] + [(120, None), (None, ["w1", "w2"])]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    monkeypatch.setattr(embed, "PART_TOKENS", 200)  # 8 parts
    found = []
    for waves in (1, 3):
        monkeypatch.setattr(embed, "_waves", lambda *_, waves=waves: waves, raising=False)
        before = {p.name for p in kept.rglob("rdd-*")}
        found.append({r.word: r.vector for r in getattr(embed, mode)(df, size=8, epochs=4, rate=0.1).collect()})
        assert len({p.name for p in kept.rglob("rdd-*")} - before) == 1  # the model that is returned
    assert set(found[0]) == set(found[1]) and all(np.allclose(v, found[1][w], atol=1e-4) for w, v in found[0].items())


def test_neighbours_over_blocks_larger_than_one_product(spark):
    v = np.random.default_rng(4).standard_normal((3 * embed.AT_ONCE // 2, 4))
    table = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(v)], "id long, vector array<double>")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    scores = np.round(u @ u.T, 6)
    np.fill_diagonal(scores, -2)
    got = defaultdict(list)
    for r in embed.neighbours(table, table.select("id"), 3, "id", batch=1000, rows=100).orderBy("rank").collect():
        got[r.query].append(r.similarity)
    assert len(got) == len(v) and all(np.allclose(got[i], np.sort(scores[i])[::-1][:3], atol=2e-6) for i in got)


def test_document_vectors_ignore_unknown_words(spark):
    docs = spark.createDataFrame([(1, ["x", "y", "zzz"]), (2, ["zzz"])], "doc_id long, tokens array<string>")
    vectors = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [0.0, 1.0])], "word string, vector array<double>")
    got = {r.doc_id: r.vector for r in embed.document_vectors(docs, vectors, 2).collect()}
    assert got == {1: [0.5, 0.5], 2: [0.0, 0.0]}


def test_document_vectors_over_parts(spark, monkeypatch):
    monkeypatch.setattr(embed, "PART_WORDS", 3, raising=False)
    docs = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["b", "x"]), (3, ["x"]), (4, []), (5, None), (6, ["c"]), (6, ["a"]), (None, ["a"])], "doc_id long, tokens array<string>")
    words = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [4.0, 8.0]), ("c", [0.0, 3.0]), ("c", [6.0, 0.0])], "word string, vector array<double>")
    got = embed.document_vectors(docs, words, 2)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan  # a vector once a part and word, not once a document and word
    found = sorted((r.doc_id or 0, [round(v, 6) for v in r.vector]) for r in got.collect())
    third = [round(7 / 3, 6), round(5 / 3, 6)]
    assert found == [(0, [0.0, 0.0]), (1, [2.0, 4.0]), (2, [4.0, 8.0]), (3, [0.0, 0.0]), (4, [0.0, 0.0]), (5, [0.0, 0.0]), (6, third), (6, third)]


def test_independent_fits_run_side_by_side():
    import threading

    from corpusloom.session import beside

    meet = threading.Barrier(2, timeout=20)
    assert beside(lambda i: (meet.wait(), i)[1], [1, 2]) == [1, 2]  # one after the other would never meet


def test_top_k_over_blocks_lists_no_candidates(spark):
    rng = np.random.default_rng(3)
    docs = spark.createDataFrame([(d, f"t{t}", float(w)) for d in range(60) for t, w in zip(rng.choice(30, 6, False).tolist(), rng.choice([0.25, 0.5, 0.75], 6), strict=True)] + [(None, "t1", 1.0)], "doc_id long, term string, weight double")
    asked = spark.createDataFrame([(q, f"t{t}", 0.5) for q in range(7) for t in rng.choice(40, 5, False).tolist()] + [(None, "t1", 1.0)], "query_id long, term string, weight double")
    rows, want = docs.filter("doc_id IS NOT NULL").collect(), []
    for q, terms_of in asked.filter("query_id IS NOT NULL").toPandas().groupby("query_id"):
        score = defaultdict(float)
        for d, t, w in rows:
            if t in set(terms_of.term):
                score[d] += 0.5 * w
        want += [(q, d, round(s, 6), i + 1) for i, (d, s) in enumerate(sorted(score.items(), key=lambda x: (-x[1], x[0]))[:5])]
    got = retrieve.top_k(asked, docs, 5, held=4)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 1  # numbers of terms; no pairs of documents and queries
    assert sorted(tuple(r) for r in got.select("query_id", "doc_id", "cosine", "rank").collect()) == sorted(want)

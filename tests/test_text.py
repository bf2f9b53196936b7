import html

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import stems, text, tokens
from corpusloom.functions.fixed import DOMAIN_TERMS, stopwords
from corpusloom.functions.numbers import safe_float
from corpusloom.operators.audit import lemmas
from corpusloom.plans.config import Setup, Tokens
from corpusloom.plans.preprocess import preprocess


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "t string").select(fn(F.col("t")).alias("x")).first().x


def test_clean_text_order(spark):
    raw = "Fish &amp; chips <p>wow!!!</p> https://x.y/z #Tag_1 @me hai Ka ok ka's ’don't’ \U0001F600 end"
    assert one(spark, raw, text.clean_text) == "fish & chips wow! tag_1 is of ok of's 'don't' end"


def test_unescape_is_single_pass(spark):
    for raw in ("&amp;lt; &#65;&#x42; &bogus; & &quot;", "&lt;b&gt;&nbsp;&copy;&hellip;", "plain"):
        assert one(spark, raw, text.html_unescape) == html.unescape(raw)


def test_squeeze(spark):
    assert one(spark, "wow!!! eh??? a...!?", text.squeeze_punctuation) == "wow! eh? a?"


def test_tokenizers(spark):
    raw = "don't stop! covid-19 ok"
    assert one(spark, raw, lambda c: tokens.tokenize(c, "word")) == ["don't", "stop", "covid", "19", "ok"]
    assert one(spark, raw, lambda c: tokens.tokenize(c, "custom")) == ["don't", "stop", "!", "covid", "-", "19", "ok"]
    assert one(spark, raw, lambda c: tokens.tokenize(c, "nltk"))[:2] == ["do", "n't"]


def test_stopword_lists():
    assert len(stopwords("default")) == 179
    custom = set(stopwords("custom"))
    assert "not" not in custom and "covid" in custom and stopwords("none") == []


def test_stemmers(spark):
    words = [*DOMAIN_TERMS, "caresses", "ponies", "hopping", "falling", "sky", "relational", "by"]
    df = spark.createDataFrame([(w,) for w in words], "token string")
    out = {r.token: (r.p, r.s) for r in stems.stem_column(
        stems.stem_column(df, "token", "porter", "p"), "token", "snowball", "s").collect()}
    for word, pair in {"vaccines": ("vaccin", "vaccin"), "vaccination": ("vaccin", "vaccin"),
                       "misinformation": ("misinform", "misinform"), "misinformed": ("misinform", "misinform"),
                       "reported": ("report", "report"), "allegedly": ("allegedli", "alleg"),
                       "caresses": ("caress", "caress"), "ponies": ("poni", "poni"), "hopping": ("hop", "hop"),
                       "falling": ("fall", "fall"), "sky": ("sky", "sky"), "by": ("by", "by"),
                       "relational": ("relat", "relat")}.items():
        assert out[word] == pair
    arrays = spark.createDataFrame([(words,)], "t array<string>").select(
        stems.stem_array(F.col("t"), "porter").alias("p"), stems.stem_array(F.col("t"), "snowball").alias("s")).first()
    assert arrays.p == [out[w][0] for w in words] and arrays.s == [out[w][1] for w in words]


def test_lemmas(spark):
    def frame(words):
        return spark.createDataFrame([(w,) for w in words], "term string")

    found = {r.term: r.lemma for r in lemmas(
        frame(["vaccines", "vaccination", "misinformed", "reported", "studies", "glasses", "boss"]),
        frame(["vaccine", "vaccination", "misinformed", "reported", "study", "glass", "boss"])).collect()}
    assert found == {"vaccines": "vaccine", "vaccination": "vaccination", "misinformed": "misinformed",
                     "reported": "reported", "studies": "study", "glasses": "glass", "boss": "boss"}


def test_preprocess_fallback_and_lemmatizer(spark):
    df = spark.createDataFrame([(1, "The vaccines and the vaccine"), (2, "the"), (3, "<p></p>")], "doc_id long, text string")
    config = Setup("x", Tokens("custom", "lemmatizer", 2))
    lexicon = spark.createDataFrame([("shot",), ("vaccine",)], "term string")
    rows = {r.doc_id: r for r in preprocess(df, config, lexicon=lexicon).collect()}
    assert rows[1].removed_stopwords == ["the", "and", "the", "vaccine"] and rows[1].tokens == ["vaccine"]
    assert rows[2].tokens == ["the"] and rows[2].removed_stopwords == ["the"]
    assert rows[3].tokens == ["empty"]


def test_ngrams(spark):
    row = spark.range(1).select(tokens.ngrams(F.array(F.lit("a"), F.lit("b")), 3).alias("g")).first()
    assert [tuple(g) for g in row.g] == [("<s>", "<s>", "a"), ("<s>", "a", "b"), ("a", "b", "</s>")]


def test_safe_float(spark):
    df = spark.createDataFrame([("1.5",), ("nan",), ("inf",), ("x",), (None,), (" 2e3 ",)], "t string")
    assert [r.v for r in df.select(safe_float(F.col("t"), -1.0).alias("v")).collect()] == [1.5, -1, -1, -1, -1, 2000.0]


@settings(max_examples=15, deadline=None)
@given(st.text(alphabet="ab<>&;#@!?. hka'’\U0001F600\n", max_size=40))
def test_clean_text_is_stable_shape(spark, raw):
    out = one(spark, raw, text.clean_text)
    assert out == out.strip() and out == out.lower() and "  " not in out and "!!" not in out.replace("! !", "")


def test_unescape_equals_the_standard_library(spark):
    from html.entities import html5

    names = [f"a&{n}b" for n in html5] + [f"&{n[:-1]} x" for n in html5 if n.endswith(";")] + [f"&{n}1" for n in html5]
    numbers = [f"&#{i};" for i in range(300)] + [f"&#x{i:X}." for i in range(0, 300, 7)] + [
        f"&#{i};" for i in (0xD800, 0xFDD0, 0xFFFE, 0xFFFF, 0x10000, 0x1F600, 0x10FFFF, 0x110000, 10**9, 10**30)] + ["&#0000000065;", "&#x00000041;", "&#x0;"]
    rows = names + numbers + ["it&#146;s &amp lt &copy 2020", "&amp;amp;", "&&&", "&nosuchname;", "&#;", "&#x;", "& &", "plain"]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, s string")
    got = {r.i: r.t for r in df.select("i", text.html_unescape(F.col("s")).alias("t")).collect()}
    assert [(r, got[i]) for i, r in enumerate(rows) if got[i] != html.unescape(r)] == []


def test_runs_of_y(spark):
    from corpusloom.functions.stems import letter_classes

    words = ["heyyyyyyy", "yyyyb", "syzygy", "yes", "toy", "byyye", "y", "yy", "ayyyyyb", "sky", "plain"]

    def slow(word):
        out = ""
        for c in word:
            out += "v" if c in "aeiou" else "c" if c != "y" else "v" if out.endswith("c") else "c"
        return out

    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert {r.w: r.c for r in df.select("w", letter_classes(F.col("w")).alias("c")).collect()} == {w: slow(w) for w in words}


def test_texts_are_cleaned_once_and_only_with_a_label(spark, tiny, monkeypatch):
    from corpusloom.queries import base

    monkeypatch.setattr(base, "shared", lambda spark, data, name, build: build())
    plan = base.labelled(spark, tiny)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(regexp_replace(") == 1  # a second one would be the filter, below the join with the labels


def test_replacement_after_a_letter_of_two_code_units(spark):
    rows = [("\U00010428ka ka",), ("sab, hai!",), ("saba",), ("",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(text.replace_words(F.col("t"))).collect()]
    assert got == ["\U00010428ka of", "all, is!", "saba", "", None]


def test_audit_columns_and_tokens_are_computed_once(spark, monkeypatch):
    from corpusloom.operators import audit

    settled = []
    monkeypatch.setattr(audit, "settle", lambda df: settled.append(df) or df, raising=False)
    audit.describe(spark.range(4).select(F.col("id").alias("x")), ["x"])
    assert [df.columns for df in settled] == [["x"]]
    docs = spark.createDataFrame([(1, "don't go hai"), (2, None), (3, "")], "doc_id long, clean_text string")
    found = audit.compare_tokenizers(docs, spark.createDataFrame([("go",)], "term string"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 1
    rows = {r.method: r for r in found.collect()}
    assert rows["word"][1:] == (3, 1.5, 0.5, 0.5, 0.111111)  # of two texts, of three documents


def test_a_word_of_a_batch_is_stemmed_once(spark):
    words = ["Relational", "hopping", "not", "ponies", "by"]
    rows = [(i % 7 if i % 5 else None, " ".join(words[i % 3:]) if i % 4 else ["", None, "a"][i % 3]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, clean_text string")
    for algorithm in ("porter", "snowball"):
        setup = Setup("x", Tokens("default", algorithm, 2))
        done = preprocess(df, setup, cleaned="clean_text")
        assert "FlatMapCoGroupsInArrow" in done._jdf.queryExecution().optimizedPlan().toString()
        kept = tokens.keep_long(stems.stem_array(tokens.remove_stopwords(tokens.tokenize(F.col("clean_text"), "custom"), "default"), algorithm), 2)
        want = df.select("doc_id", "clean_text", tokens.or_fallback(kept, F.col("clean_text")).alias("t"))
        assert sorted(map(str, done.select("doc_id", "clean_text", "tokens").collect())) == sorted(str(r).replace(", t=", ", tokens=") for r in want.collect())


def test_only_alphabetic_words_meet_the_lexicon(spark):
    from collections import Counter

    from corpusloom.operators import audit

    rows = [(1, "Don't GO go, 12 ok!"), (2, None), (2, "ok zz"), (None, "zz go"), (None, "hai"), (3, ""), (4, "can't 7")]
    docs = spark.createDataFrame(rows, "doc_id long, clean_text string")
    found = audit.compare_tokenizers(docs, spark.createDataFrame([("go",), ("do",)], "term string"))
    assert "LeftAnti" in found._jdf.queryExecution().optimizedPlan().toString()  # one row a document and word, not one a method
    for r in found.collect():
        cut = docs.select("doc_id", tokens.tokenize(F.col("clean_text"), r.method).alias("t")).collect()
        held = Counter()
        for doc, words in cut:
            for w in words or []:
                held[doc] += 1
                held[doc, "bad"] += w.isalpha() and w.lower() not in ("go", "do")
        shares = [held[d, "bad"] / held[d] for d in {d for d, t in cut if t}]
        known = sum(t is not None for _, t in cut)
        assert r.documents == len(rows) and r.avg_tokens == round(sum(len(t or []) for _, t in cut) / known, 6)
        assert r.avg_oov_rate == round(sum(shares) / len(rows), 6)
        assert r.avg_contractions == round(sum("'" in w for _, t in cut for w in t or []) / known, 6)

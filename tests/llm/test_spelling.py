"""Spelling variants against brute force."""

import collections
import random
import re
import zlib

from corpusloom.llm import queries, spelling


def slow_words(rows):
    seen = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{word}".encode())
            if i is not None and h % 199 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            seen[word] += 1
    return {w: n for w, n in seen.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow_variants(vocabulary):
    near = {w: [v for v in vocabulary if one_edit(w, v)] for w in vocabulary}

    def form(w):
        best = min(near[w], key=lambda v: (-vocabulary[v], v), default=None)
        return best if best is not None and vocabulary[best] >= 5 * vocabulary[w] else None

    def root(w):
        while form(w) is not None:
            w = form(w)
        return w

    return {(w, form(w), root(w), n, len(near[w]), vocabulary.get(form(w))) for w, n in vocabulary.items()}


def run(spark, vocabulary):
    return [tuple(r) for r in spelling.variants(spark.createDataFrame(list(vocabulary.items()), "word string, n long")).collect()]


def test_words(spark, hard):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(["Colour", "ÉCOLES", "naïveté", "straße", "abcdef×gh", "short", "Ωmega", "letters2digits"]) for _ in range(400))) for k in range(60)]
    rows += [(None, "Colour " * 30), (7, None), (7, "")]
    got = [tuple(r) for r in spelling.words(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert dict(got) == slow_words(rows) and len(got) == len(dict(got)) > 6  # words with a slip are among them
    assert {tuple(r) for r in spelling.words(hard).collect()} == set(slow_words([(r.doc_id, r.text) for r in hard.collect()]).items())


def test_variants_equal_all_pairs(spark):
    rng = random.Random(4)
    words = {}
    for _ in range(250):  # few letters, many repeats: several deletions give the same word
        words["".join(rng.choice("aabé") for _ in range(rng.randrange(6, 9)))] = rng.choice([5, 6, 25, 30, 31, 150, 800, 4000])
    words |= {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "aaaaaaab": 125, "bcdefg": 9, "cdefgb": 50, "xyzxyz": 5, "yzxyzx": 100}
    got = run(spark, words)
    assert len(got) == len(words) and set(got) == slow_variants(words)
    assert sum(r[4] for r in got) > 300 and any(r[1] != r[2] for r in got if r[1])


def test_ends_of_words_do_not_meet(spark):
    """Rotations of different words that are equal without their terminator are no neighbours."""
    assert {r[0]: r[4] for r in run(spark, {"abcdef": 5, "bcdefa": 50, "fabcde": 50, "abcdefa": 50, "bcdefab": 9})} == {
        "abcdef": 1, "bcdefa": 2, "fabcde": 0, "abcdefa": 2, "bcdefab": 1}


def test_long_chains(spark):
    words = {("a" * k) + "bcdefg": 5 ** (k + 1) for k in range(12)}
    assert set(run(spark, words)) == slow_variants(words)


def test_tables(spark, docs, empty, tiny):
    want = slow_variants(slow_words([(r.doc_id, r.text) for r in docs.collect()]))
    rows = queries.QUERIES["op12_spelling"](spark, tiny)
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in rows.collect()} == want and spelling.spelling_variants(empty).count() == 0

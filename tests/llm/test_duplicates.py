"""Duplicate detection and decontamination against brute force."""

import collections
import hashlib
import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import contamination, graph, sentences, simhash, suffix


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def slow_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in nodes}


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("aB \n\tÄ ."), max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) & (1 << 64) - 1 == slow_fingerprint(text)


@pytest.mark.parametrize("crowd", [64, 2])
def test_links_equal_all_pairs(spark, crowd):
    rng = random.Random(5)
    codes = set()
    for _ in range(12):
        seed = rng.getrandbits(64)
        for _ in range(12):
            code = seed
            for b in rng.sample(range(64), rng.randrange(4)):
                code ^= 1 << b
            codes.add(code - (1 << 63))
    frame = spark.createDataFrame([(c,) for c in sorted(codes)], "fp long")
    got = slow_components(codes, [tuple(r) for r in simhash.links(frame, crowd).collect()])
    near = [(a, b) for a in codes for b in codes if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 2]
    assert near and got == slow_components(codes, near)


@pytest.mark.parametrize("crowd", [64, 0])
def test_near_duplicates(docs, texts, crowd):
    prints = {i: slow_fingerprint(t) for i, t in texts.items()}
    near = [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= 2]
    want = slow_components(prints, near)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs, crowd).collect()}
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{prints[i]:016x}", want[i]) for i in prints}
    assert {r.doc_id for r in simhash.keep_first(docs).collect()} == set(want.values())


def test_near_duplicates_of_hard_rows(hard, empty):
    rows = simhash.near_duplicates(hard).collect()
    assert len(rows) == hard.count() and simhash.near_duplicates(empty).count() == 0
    group = {r.doc_id: r.component_id for r in rows}
    assert group[1] == group[5] == 1 and group[2] == group[3] == group[4] == 2
    kept = simhash.keep_first(hard)
    assert kept.columns == hard.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == sorted(
        i for i in [r.doc_id for r in hard.collect() if r.doc_id] if group[i] == i)


def test_components_of_a_long_path(spark):
    rng = random.Random(1)
    order = list(range(200))
    rng.shuffle(order)
    path = spark.createDataFrame(list(zip(order, order[1:], strict=False)), "a long, b long")
    assert {tuple(r) for r in graph.components(path).collect()} == {(i, 0) for i in range(200)}
    assert graph.components(path.limit(0)).count() == 0


def slow_removal(all_texts):
    count = collections.Counter(b[i:i + 200] for b in all_texts for i in range(len(b) - 199))
    for b in all_texts:
        gone = [False] * len(b)
        for i in range(len(b) - 199):
            if count[b[i:i + 200]] > 1:
                gone[i:i + 200] = [True] * 200
        yield (len(b), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)),
               hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest())


@pytest.mark.parametrize("crowd", [64, 1])
def test_repeated_strings(spark, hard, empty, docs, texts, crowd, monkeypatch):
    monkeypatch.setattr(suffix, "CROWD", crowd)
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh ") for _ in range(1200))
    made = ["", None, "a" * 1000, "a" * 199, "ab" * 300, base, base[:600] + "Z" + base[600:], base[300:520], "é" * 150 + base[100:400],
            "xyz" * 300 + base] + [base[i:i + 230] + str(i) for i in range(0, 900, 13)] + list(texts.values())[:60]
    frame = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = [tuple(r)[1:] for r in suffix.drop_repeats(frame).orderBy("doc_id").collect()]
    assert got == list(slow_removal([(t or "").encode() for t in made]))
    rows = [(r.doc_id, (r.text or "").encode()) for r in hard.collect()]
    want = sorted(((i, *w) for (i, _), w in zip(rows, slow_removal([b for _, b in rows]), strict=True)), key=str)
    assert sorted((tuple(r) for r in suffix.drop_repeats(hard).collect()), key=str) == want
    assert suffix.drop_repeats(empty).count() == 0


def test_remaining_bytes(spark):
    rng = random.Random(8)
    base, ends = ("".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (250, 90))
    frame = spark.createDataFrame([(1, base + ends), (2, "Ä" + base), (3, ends), (4, None)], "doc_id long, text string")
    kept = {r.doc_id: bytes(r.kept) for r in suffix.remaining(frame).collect()}
    assert kept == {1: ends.encode(), 2: "Ä".encode(), 3: ends.encode(), 4: b""}


def test_anchors_in_parts(monkeypatch):
    rng = random.Random(2)
    text = bytes(rng.choice(b"abcd ") for _ in range(5000))
    whole = suffix.anchors(text)
    monkeypatch.setattr(suffix, "PART", 700)
    place, first, last = suffix.anchors(text)
    assert {(p, s) for p, f, z in zip(place, first, last, strict=True) for s in range(f, z + 1)} == {
        (p, s) for p, f, z in zip(*whole, strict=True) for s in range(f, z + 1)}


def test_sentence_spans(spark, hard, empty):
    passage = "First of all comes this one here. Then the second of them follows on. At last a third one ends it all, as it were."
    alone = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"Own start. {passage} Own end."), (2, f"Other words. {passage} Nothing more."), (3, passage.replace(" ", "  ")),
            (4, "Short one. Short one. Short one. Short one."), (5, f"Yes.\n{alone}\nNo."), (6, f"So.\n{alone}\nLa."), (7, None)]
    got = {r.doc_id: r for r in sentences.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept_text == rows[0][1] and got[2].kept_text == "Other words. Nothing more." and got[3].kept_text == ""
    assert got[4].n_removed == 0 and got[5].n_removed == 0 and got[6].kept_text == "So.\nLa." and got[7].kept_text == ""
    assert all(r.kept_sha256 == hashlib.sha256(r.kept_text.encode()).hexdigest() for r in got.values())
    rows = sentences.drop_repeats(hard).collect()
    assert len(rows) == hard.count() and sentences.drop_repeats(empty).count() == 0
    assert next(r.kept_text for r in rows if r.doc_id is None) == "no id"


def test_rows_that_share_an_id(spark):
    one, two = ("".join(f"{w} sentence number {i} is here. " for i in range(8)) for w in ("First", "Other"))
    rows = [(1, one), (1, one), (2, two), (2, "Some start of it. " + one), (3, two), (None, one)]
    got = sorted((r.doc_id or 0, r.kept_text) for r in sentences.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([(0, one), (1, one), (1, one), (2, two), (2, "Some start of it. "), (3, "")])


def test_sentences_join_to_the_text(texts):
    for text in [*texts.values(), "", " \n ", "one,two " * 3000, "x" * 5000, "\n\n a"]:
        parts = sentences.sentences((text or "").encode())
        assert b"".join(p for p, _ in parts) == (text or "").encode() and all(p.split() == w and len(w) <= sentences.LONG for p, w in parts)


@pytest.mark.parametrize("held", [1 << 19, 300])
def test_all_runs_against_brute_force(spark, texts, held, monkeypatch):
    """Every run of two sentences or more, not only the shortest ones."""
    monkeypatch.setattr(sentences, "HELD", held)
    rng = random.Random(9)
    parts = {i: sentences.sentences(t.encode()) for i, t in texts.items()}
    some = {i: texts[i] for i in sorted(parts) if len(parts[i]) < 100}
    pool = [p.decode() for i in list(some)[:20] for p, _ in parts[i]]
    for k in range(60):  # texts made of stretches of others
        cuts = [rng.randrange(len(pool)) for _ in range(4)]
        some[10**6 + k] = " ".join("".join(x + " " for x in pool[c:c + rng.randrange(1, 12)]) for c in cuts)
    known, first, gone = {}, {}, collections.defaultdict(set)
    for i in sorted(some):
        words = [tuple(w) for _, w in sentences.sentences(some[i].encode())]
        for a in range(len(words)):
            run = size = 0
            for b in range(a, len(words)):
                run = known.setdefault((run, words[b]), len(known) + 1)
                size += len(words[b])
                if b > a and size >= 15 and first.setdefault(run, (i, a)) != (i, a):
                    gone[i].update(range(a, b + 1))
    got = {r.doc_id: r.n_removed for r in sentences.drop_repeats(spark.createDataFrame(list(some.items()), "doc_id long, text string").repartition(3)).collect()}
    assert got == {i: len(gone[i]) for i in some} and sum(got.values()) > 500


def test_passages_of_over_fifty_words(spark, texts):
    """Runs of 51 words of a text, begun anywhere, inside other words."""
    rng = random.Random(10)
    rows, n = [], 0
    for i in sorted(texts)[:120]:
        words = re.findall(r"\S+\s*", texts[i] or "")
        if len(words) < 120:
            continue
        at = rng.randrange(len(words) - 51)
        if len(set(words[at:at + 51])) < 10:  # one word over and over has no places of its own to cut at
            continue
        rows.append((n, "".join(words)))
        rows.append((10**6 + n, " ".join(f"x{rng.randrange(10**6)}" for _ in range(30)) + " " + "".join(words[at:at + 51]) + " " + " ".join(f"y{rng.randrange(10**6)}" for _ in range(30))))
        n += 1
    got = {r.doc_id: r for r in sentences.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    made = [got[10**6 + k] for k in range(n)]
    caught = sum(r.n_removed > 0 for r in made) / n
    print(f"{n} passages, caught {caught:.3f}, words removed of 51: {sum(r.n_removed_words for r in made) / n:.1f}")
    assert n > 50 and caught == 1 and sum(r.n_removed_words for r in made) / n > 35


def edits(window, region):
    row = [0] * (len(region) + 1)
    for i, c in enumerate(window, 1):
        new = [i]
        for j, e in enumerate(region, 1):
            new.append(min(row[j - 1] + (c != e), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_contamination_against_alignment():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("aeiounrst") for _ in range(rng.randrange(2, 7)))
    for _ in range(120):
        window = contamination.plain(" ".join(word() for _ in range(40)))[:rng.choice((9, 30, 70, contamination.WINDOW))].strip()
        region = bytearray(window)
        for _ in range(rng.randrange(15)):
            p = rng.randrange(len(region))
            region[p:p + rng.randrange(2)] = rng.choice([b"x", b"", b"q"])
            region = region or bytearray(b"x")
        text = contamination.plain("zzz yyy qqq " * rng.randrange(1, 20)) + b" " + bytes(region) + b" end of it"
        index = contamination.Index([("item", window)])
        assert bool(index.found(text)) == (edits(window, text) <= int(index.edits[0])), (window, text)


def test_contamination(spark, hard, empty, docs, texts, tiny):
    benchmark = spark.read.parquet(f"{tiny}/benchmark.parquet")
    items = {r.item_id: contamination.plain(r.text) for r in benchmark.collect()}
    got = {r.doc_id: r for r in contamination.flag(docs, benchmark).collect()}
    for i, text in texts.items():
        exact = {k for k, t in items.items() if t in contamination.plain(text)}
        assert exact <= set(got[i].items) and got[i].contaminated == (got[i].n_items > 0)
    assert sum(r.contaminated for r in got.values()) > 0
    own = spark.createDataFrame([(1, "Words here AND more"), (2, None), (3, ""), (4, "dup"), (4, "dup"), (None, "no id")], "item_id long, text string")
    found = {r.doc_id: r.items for r in contamination.flag(hard, own).collect()}
    assert found[1] == found[5] == [1] and found[12] == [4, 4] and found[None] == [None] and found[3] == [] and found[10] == []
    assert contamination.flag(empty, own).count() == 0
    assert contamination.flag(hard, own.limit(0)).filter("contaminated").count() == 0
    kept = contamination.drop_contaminated(hard, own)
    assert kept.columns == hard.columns and {r.doc_id for r in kept.collect()} == {2, 3, 4, 6, 7, 8, 9, 10, 11, 13, 14} - {6}


@pytest.mark.parametrize("words, least", [(15, 0.9), (17, 1.0), (25, 1.0)])
def test_partial_copies(words, least):
    """Stretches of an item inside other text, at every place."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghilmnoprstuvwy") for _ in range(rng.choice((3, 4, 5, 5, 6, 7, 8))))
    item = [word() for _ in range(60)]
    index = contamination.Index([("item", contamination.plain(" ".join(item)))])
    found = [bool(index.found(contamination.plain(" ".join([word() for _ in range(40)] + item[a:a + words] + [word() for _ in range(40)]))))
             for a in range(60 - words + 1)]
    print(words, sum(found), len(found))
    assert sum(found) / len(found) >= least
    assert not any(index.found(contamination.plain(" ".join(word() for _ in range(150)))) for _ in range(50))


def test_blocks_of_the_benchmark(docs, spark, tiny, monkeypatch):
    benchmark = spark.read.parquet(f"{tiny}/benchmark.parquet")
    want = {r.doc_id: sorted(r.items) for r in contamination.flag(docs, benchmark).collect()}
    monkeypatch.setattr(contamination, "BLOCK_BYTES", 2000)
    assert len(list(contamination.blocks(benchmark))) > 2
    assert {r.doc_id: sorted(r.items) for r in contamination.flag(docs, benchmark).collect()} == want

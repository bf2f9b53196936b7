"""Tensored MinHash groups against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import common, minhash, queries


def slow_sets(texts, size=2):
    sets = {}
    for i, text in texts.items():
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
    return sets


def slow_groups(texts, percent=80):
    """``id: (set size, component)`` and the number of links between different sets."""
    sets, group, links = slow_sets(texts), {i: i for i in texts}, 0

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                group[y] = x
                links += sets[a] != sets[b]
    return {i: (len(sets[i]), find(i)) for i in texts}, links


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string")


def found(spark, texts):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame(spark, texts)).collect()}


@pytest.fixture(scope="module")
def families():
    """Copies with edits around the threshold, chains of them, families with heavily edited members."""
    rng = random.Random(11)
    made, i = {}, 10**6
    for _ in range(6):
        base = [f"w{rng.randrange(5000)}" for _ in range(120)]
        for n in (0, 2, 4, 5, 6, 7, 8):
            made[i] = " ".join(edited(rng, base, n))
            i += 1
        for _ in range(6):
            base = edited(rng, base, 5)
            made[i] = " ".join(base)
            i += 1
    base = [f"w{rng.randrange(5000)}" for _ in range(100)]
    for k in range(150):
        made[i] = " ".join(edited(rng, base, k % 12))
        i += 1
    return made | {i: "", i + 1: None, i + 2: "one", i + 3: "ONE", i + 4: "one one", i + 5: " \n"}


def test_groups_equal_all_pairs(spark, texts, families):
    want, links = slow_groups(texts | families)
    assert found(spark, texts | families) == want and links > 500


def test_blocks_change_nothing(spark, families, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 7)
    assert found(spark, families) == slow_groups(families)[0]


def test_blocks_are_bounded_and_links_do_not_grow_with_pairs(spark, families, monkeypatch):
    docs = frame(spark, families)
    nodes = minhash.prints(docs).filter("n > 0").dropDuplicates(["digest"]).withColumnRenamed("doc_id", "first").withColumn("node", F.col("first"))
    sets = minhash.whole_sets(docs, common.settle(nodes, "nodes")).withColumn("root", F.col("node"))
    cell = sets.select(F.lit(0).cast("long").alias("cell"), F.lit(-1).alias("place"), "node")
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 50)
    blocks = -(-sets.count() // 50)
    assert 0 < minhash.linked(cell, cell, sets, 80).count() <= blocks * blocks * 100


def test_shingles(texts):
    for text in [*list(texts.values())[:20], "", None, "a", "A b", "a b a b a", "x " * 20000]:
        assert len(minhash.shingles(text or "")) == len(slow_sets({0: text})[0])
    one, two, three = (minhash.shingles(t) for t in ("a", "a a", "A\n a"))
    assert not set(one) & set(two) and np.array_equal(two, three)
    assert len(minhash.shingles("a b c", 3)) == 1 and np.array_equal(minhash.shingles("a b", 3), minhash.shingles("A B", 2))


def test_parts_do_not_depend_on_chunks(monkeypatch):
    some = minhash.shingles(" ".join(map(str, range(500))))
    whole = minhash.parts(some)
    monkeypatch.setattr(minhash, "CHUNK", 7)
    assert np.array_equal(whole, minhash.parts(some)) and len(set(whole.tolist())) == 2 * minhash.SIDE


def test_keys_meet_where_both_collections_do(spark):
    """A key is shared just where a part of each collection is."""
    rng = random.Random(3)
    nodes = [(k, [c * 100 + rng.randrange(3) for c in range(2 * minhash.SIDE)]) for k in range(12)]
    nodes.append((99, [10**6 + c for c in range(2 * minhash.SIDE)]))
    keys = {}
    for r in minhash.keys(spark.createDataFrame(nodes, "node long, parts array<long>")).collect():
        keys.setdefault(r.node, set()).add(r.key)
    assert 99 not in keys
    for a, x in nodes[:-1]:
        for b, y in nodes[:-1]:
            first, second = (sum(x[c] == y[c] for c in half) for half in (range(minhash.SIDE), range(minhash.SIDE, 2 * minhash.SIDE)))
            assert a == b or len(keys.get(a, set()) & keys.get(b, set())) == first * second


def test_hard_rows(spark, hard, empty):
    rows = minhash.near_duplicates(hard).collect()
    assert len(rows) == hard.count()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert got[1] == [(6, 1, True)] and got[5] == [(6, 1, False)]
    assert got[2] == [(0, 2, True)] and got[3] == [(0, 3, True)] and got[4] == [(0, 4, True)]
    assert got[12] == [(1, 12, True)] * 2 and got[None] == [(1, None, None)]
    assert minhash.near_duplicates(empty).count() == 0


def test_query(spark, tiny, texts):
    rows = queries.QUERIES["op11_minhash"](spark, tiny)
    assert rows.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows.collect()} == slow_groups(texts)[0]

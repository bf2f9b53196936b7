"""Source divergence against sums in plain Python."""

import collections
import random
import re

import numpy as np
import pytest

from corpusloom.llm import divergence, queries
from corpusloom.llm.perfecthash import PerfectHash


def slow_audit(rows):
    rows = [tuple(v or "" for v in r) for r in rows]
    found = [(lang, source, re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))) for lang, source, text in rows]
    out = set()
    for lang in {r[0] for r in rows}:
        mine = [r for r in found if r[0] == lang]
        docs = collections.Counter(t for _, _, ts in mine for t in set(ts))
        kept = sorted(t for t, n in docs.items() if n >= 3)
        counts = {s: collections.Counter() for _, s, _ in mine}
        for _, s, ts in mine:
            counts[s].update(t for t in ts if docs[t] >= 3)

        def shares(c, kept=kept):
            total = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        whole, each = shares(sum(counts.values(), collections.Counter())), {s: shares(c) for s, c in counts.items()}
        for s, p in each.items():
            pairs = {o: sum((p[t] - q[t]) ** 2 // q[t] for t in kept) for o, q in each.items() if o != s}
            terms = {t: (p[t] - whole[t]) ** 2 // whole[t] for t in kept if counts[s][t] and p[t] > whole[t]}
            for part, values, top in (("pair", pairs, None), ("term", terms, 200)):
                order = sorted(values, key=lambda k: (-values[k], k.encode()))[:top]
                out |= {(lang, s, part, k, values[k], r + 1) for r, k in enumerate(order)}
    return out


def made(rng):
    words = [f"w{'xyzé'[i % 4]}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)] + ["naïve", "Ω", "a", "😀"]
    rows = []
    for lang, sources in (("en", 5), ("fr", 2), ("solo", 1), (None, 2), ("none", 2)):
        for _ in range(40 if lang != "none" else 2):
            source = rng.randrange(sources) if lang else None
            favourite = words[100 * (source or 0):]
            rows.append((lang, f"s{source}" if source is not None else rng.choice([None, "s0"]), " ".join(rng.choice(favourite).upper() for _ in range(rng.randrange(60)))))
    return [*rows, ("en", "no terms", "12 34"), ("en", "null text", None), ("en", "empty", ""), ("en", "s0", rows[0][2]), ("empty", "s0", None), ("empty", "s1", "x")]


@pytest.mark.parametrize("shard_terms, broadcast_bytes", [(1 << 15, 64 << 20), (20, 4000)])
def test_audit(spark, shard_terms, broadcast_bytes):
    rows = made(random.Random(6))
    frame = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr("*", "1 AS slot", "'x' AS n", "2 AS doc_id")
    got = [tuple(r) for r in divergence.audit(frame, shard_terms, broadcast_bytes).collect()]
    assert len(got) == len(set(got)) and set(got) == slow_audit(rows)


def test_small_blocks_and_few_slots(spark):
    rows = made(random.Random(7))
    frame = spark.createDataFrame(rows, "lang string, source string, text string")
    assert {tuple(r) for r in divergence.audit(frame, block=16, held=700).collect()} == slow_audit(rows)


def test_only_kept_terms_are_remembered():
    strings = [f"t{i}".encode() for i in range(400)]
    finder = divergence._Finder({0: (7, PerfectHash(strings))}, 1)
    want = PerfectHash(strings).slots(strings).tolist()
    for k in range(0, 400, 40):
        assert finder.slots([*strings[k:k + 40], b"none", strings[k]]).tolist() == [*want[k:k + 40], -1, want[k]]
    assert set(finder.known) == set(strings)


def test_first_pass_in_small_parts(spark, monkeypatch):
    rows = made(random.Random(5))
    frame = spark.createDataFrame(rows, "lang string, source string, text string")
    want = {tuple(r) for r in divergence.frequent(frame).collect()}
    monkeypatch.setattr(divergence, "REMEMBERED", 10)
    assert {tuple(r) for r in divergence.frequent(frame).collect()} == want


def test_query(spark, tiny, hard, empty):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = queries.QUERIES["op13_divergence"](spark, tiny)
    assert rows.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert {tuple(r) for r in rows.collect()} == slow_audit([(r.lang, r.source, r.text) for r in docs.collect()])
    more = hard.selectExpr("'l' AS lang", "string(doc_id) AS source", "text", "key", "n")
    assert {tuple(r) for r in divergence.audit(more).collect()} == slow_audit([(r.lang, r.source, r.text) for r in more.collect()])
    assert divergence.audit(empty.selectExpr("key AS lang", "key AS source", "text")).count() == 0


def test_shares_are_exact():
    rng = random.Random(8)
    for _ in range(300):
        total = rng.randrange(1, 9 * 10**13)
        count = rng.randrange(min(total, 10**rng.randrange(1, 14)))
        assert int(divergence.share(np.array([count]), total)[0]) == 1 + 10**9 * (count + 1) // total


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash(n):
    strings = [f"term{i}é".encode() for i in range(n)]
    hashed = PerfectHash(strings)
    assert sorted(hashed.slots(strings).tolist()) == list(range(n))
    assert all(hashed.strings[s] == t for s, t in zip(hashed.slots(strings).tolist(), strings, strict=True))
    others = [f"other{i}".encode() for i in range(3000)]
    assert set(hashed.slots(others).tolist()) == {-1}


def test_perfect_hash_of_keys_that_never_part(monkeypatch):
    monkeypatch.setattr("corpusloom.llm.perfecthash.LEVELS", 1)
    strings = [str(i).encode() for i in range(500)]
    hashed = PerfectHash(strings)
    assert hashed.rest and sorted(hashed.slots(strings).tolist()) == list(range(500)) and hashed.slots([b"x", b"y"]).tolist() == [-1, -1]

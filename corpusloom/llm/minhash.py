"""MinHash near-duplicates by tensored banding.

A text is the set of its runs of ``SHINGLE`` words.  Two small collections of
``SIDE`` parts are drawn, each part the minima of ``ROWS`` hash functions; a table
key is one part of the first collection with one of the second, so ``2 * SIDE *
ROWS`` minhashes give ``SIDE * SIDE`` keys of ``2 * ROWS`` minima.  Two texts share
a key just when they share a part in each collection: at a similarity of 0.8 they
miss with probability ``1 - (1 - (1 - 0.8^ROWS)^SIDE)^2``, two in 100,000.

Every candidate is decided on the whole sets, by one streaming comparison of
*seeds* with *members* that meet in a cell:

1. in each bucket the member with the smallest node is the seed of the others (of
   those seeds, the ``LEADS`` that a text shares most keys with);
2. in a bucket that those links leave apart, the members outside its largest group
   are seeds of all its members.

Cells are cut into blocks of bounded size on both sides, so a family of any size is
spread over tasks; pairs are never written out, only links that join two groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, settle, small_batches
from .graph import components

#: Words of a shingle, least similarity in percent, parts of a collection, minima of a part, hash seed.
SHINGLE, PERCENT, SIDE, ROWS, SEED = 2, 80, 16, 3, 42
#: Seeds that a text is compared with first.
LEADS = 2
#: Texts and shingles one side of a block holds at most on average; shingles whose minima are taken at once.
BLOCK_ROWS, BLOCK_SHINGLES, CHUNK = 1024, 1 << 20, 1 << 9
_draw = np.random.Generator(np.random.PCG64(SEED))
TIMES = _draw.integers(0, 1 << 32, (2 * SIDE * ROWS, 1), np.uint32) | np.uint32(1)
PLUS = _draw.integers(0, 1 << 32, (2 * SIDE * ROWS, 1), np.uint32)
MIX = _draw.integers(0, 1 << 64, (2 * SIDE, ROWS), np.uint64) | np.uint64(1)
STEP, TAG = (np.uint64(v) | np.uint64(1) for v in _draw.integers(0, 1 << 64, 2, np.uint64))


def _scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles; of all its words where it has fewer than ``size``."""
    words = text.encode().lower().split()  # bytes: only A-Z and the six ASCII spaces count
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(size, len(words))
    total = np.full(len(each) - k + 1, np.uint64(k)) * TAG  # tells sizes apart
    for j in range(k):
        total = total * STEP + each[j:len(each) - k + 1 + j]
    return np.unique(_scramble(total))


def parts(some: np.ndarray) -> np.ndarray:
    """The parts of both collections, first one then the other; a part's place is mixed into its value."""
    short = (some >> np.uint64(32)).astype(np.uint32)
    least = np.min([(short[i:i + CHUNK] * TIMES + PLUS).min(1) for i in range(0, len(short), CHUNK)], axis=0).reshape(2 * SIDE, ROWS)
    return _scramble((_scramble(least.astype(np.uint64)) * MIX).sum(1, dtype=np.uint64))


def _digest(some: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(some.tobytes())


def prints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, digest, n, parts``: each row's shingle set by its digest, with its size and parts (none of an empty set)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, size) for t in batch.column(1).to_pylist()]
            drawn = [parts(s).view(np.int64) if len(s) else np.zeros(0, np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(_digest, sets), pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(drawn, pa.list_(pa.int64()))], ["doc_id", "digest", "n", "parts"])

    source = id_and_text(docs)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, digest binary, n bigint, parts array<bigint>")


def whole_sets(docs: DataFrame, nodes: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``node, n, parts, held`` for ``nodes (node, first, digest, parts)``: whole shingle sets, from the texts of their first documents.

    Only texts of candidates are cut again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, digest, text in zip(*(batch.column(c).to_pylist() for c in ("node", "digest", "text")), strict=True):
                some = shingles(text, size)
                if _digest(some) == digest:  # rows may share an id
                    rows.append((node, some.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["node", "held"])

    texts = id_and_text(docs).join(nodes.select(F.col("first").alias("doc_id"), "node", "digest"), "doc_id").select("node", "digest", "text")
    found = texts.mapInArrow(run, "node bigint, held binary").dropDuplicates(["node"]).join(nodes.select("node", "n", "parts"), "node")
    return settle(found.select("node", "n", "parts", "held"), "sets")


def keys(nodes: DataFrame) -> DataFrame:
    """``node, key``: the keys of each node, of parts that at least two nodes have.

    A key is shared only if both its parts are, so parts of one node alone, most of
    all, are dropped before they are combined.
    """
    each = nodes.select("node", F.posexplode("parts").alias("place", "part"))
    shared = each.groupBy("part").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("part")
    live = each.join(shared, "part").groupBy("node").agg(
        F.collect_list(F.when(F.col("place") < SIDE, F.col("part"))).alias("one"), F.collect_list(F.when(F.col("place") >= SIDE, F.col("part"))).alias("two"))
    return (live.select("node", F.explode("one").alias("a"), "two").select("node", "a", F.explode("two").alias("b"))
            .select("node", F.xxhash64("a", "b").alias("key")))


def linked(seeds: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` that join the groups of similar seeds and members of one cell.

    ``seeds`` and ``members`` have ``cell, place, node``; ``sets`` has ``node, root, n,
    parts, held``.  A pair is compared where its groups (``root``) differ, both
    collections agree in a part, and the cell is the first of its places at which they
    do (``place`` below zero: any).  Links that join nothing new within a block are
    left out, so a block gives fewer links than it has nodes.
    """
    small_batches(sets.sparkSession)
    both = settle(seeds.withColumn("side", F.lit(0)).unionByName(members.withColumn("side", F.lit(1)))
                  .join(sets.select("node", "n"), "node"), "cells")
    wide = both.groupBy("cell", "side").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    wide = wide.groupBy("cell").agg(F.max(F.when(F.col("side") == 0, F.col("blocks"))).alias("down"), F.max(F.when(F.col("side") == 1, F.col("blocks"))).alias("across"))
    own = F.when(F.col("side") == 0, F.col("down")).otherwise(F.col("across"))
    other = F.when(F.col("side") == 0, F.col("across")).otherwise(F.col("down"))
    dealt = (both.join(wide.filter("down > 0 AND across > 0"), "cell")
             .select("cell", "place", "node", "side", F.pmod(F.xxhash64("node"), own).alias("mine"), F.explode(F.sequence(F.lit(0).cast("long"), other.cast("long") - 1)).alias("yours"))
             .select("cell", "place", "node", "side", F.when(F.col("side") == 0, F.col("mine")).otherwise(F.col("yours")).alias("down"),
                     F.when(F.col("side") == 0, F.col("yours")).otherwise(F.col("mine")).alias("across")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at = _Block(percent), None
        a: list[int] = []
        b: list[int] = []
        for batch in batches:
            tags = list(zip(*(batch.column(c).to_pylist() for c in ("cell", "down", "across")), strict=True))
            rows = zip(tags, *(batch.column(c).to_pylist() for c in ("place", "side", "node", "root", "parts", "held")), strict=True)
            for tag, place, side, node, root, drawn, some in rows:
                if tag != at:
                    block, at = _Block(percent), tag
                if side == 0:
                    block.add(node, root, drawn, some)
                else:
                    for seed in block.links(place, root, drawn, some):
                        a.append(seed)
                        b.append(node)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []

    rows = (dealt.join(sets, "node").repartition(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "cell", "down", "across")
            .sortWithinPartitions("cell", "down", "across", "side")
            .select("cell", "down", "across", "place", "side", "node", "root", "parts", "held"))
    return settle(rows.mapInArrow(run, "a bigint, b bigint").distinct(), "similar")


class _Block:
    """The seeds of one block; members are compared with all of them at once."""

    def __init__(self, percent: int) -> None:
        self.percent, self.rows, self.ready, self.up = percent, [], False, {}

    def add(self, node: int, root: int, drawn: list[int], some: bytes) -> None:
        self.rows.append((node, root, drawn, some))

    def _prepare(self) -> None:
        self.nodes, self.roots = [r[0] for r in self.rows], np.array([r[1] for r in self.rows])
        self.parts = np.array([r[2] for r in self.rows], np.int64)
        sets = [np.frombuffer(r[3], np.uint64) for r in self.rows]
        self.sizes = np.array([len(s) for s in sets])
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.values, self.starts, self.counts = np.unique(flat[order], return_index=True, return_counts=True)
        self.owners, self.ready = owner[order], True

    def _top(self, root: int) -> int:
        while (above := self.up.get(root, root)) != root:
            self.up[root] = root = self.up.get(above, above)
        return root

    def links(self, place: int, root: int, drawn: list[int], some: bytes) -> list[int]:
        """The seeds to which this member is similar, one of each group that it joins."""
        if not self.rows:
            return []
        if not self.ready:
            self._prepare()
        same = self.parts == np.array(drawn, np.int64)
        first, second = same[:, :SIDE], same[:, SIDE:]
        near = (self.roots != root) & first.any(1) & second.any(1)
        if place >= 0:
            near &= first.argmax(1) == place
        if not near.any():
            return []
        own = np.frombuffer(some, np.uint64)
        spot = np.searchsorted(self.values, own)
        spot = spot[spot < len(self.values)]
        spot = spot[self.values[spot] == own[:len(spot)]]
        many = self.counts[spot]
        runs = np.arange(int(many.sum())) + np.repeat(self.starts[spot] - (np.cumsum(many) - many), many)
        shared = np.bincount(self.owners[runs], minlength=len(self.nodes))
        near &= 100 * shared >= self.percent * (self.sizes + len(own) - shared)
        out = []
        for i in np.flatnonzero(near).tolist():
            here, there = self._top(root), self._top(int(self.roots[i]))
            if here != there:
                self.up[max(here, there)] = min(here, there)
                out.append(self.nodes[i])
        return out


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Null texts are empty.  Texts without words have no shingles and are linked with
    nothing; their component is their own id.  ``component_id`` is the smallest id
    reachable over links; a row without id is linked with nothing, and its component
    and ``kept`` are null.  Rows that repeat an id come out once each; with different
    texts, each has its text's component.  Extra columns are not read; an
    empty table gives no rows.
    """
    found = settle(prints(docs, size), "prints")
    nodes = settle(found.filter("n > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("parts").alias("parts"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    entries = keys(nodes)
    buckets = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("lead")).filter("n > 1").select("key", "lead")
    met = settle(entries.join(buckets, "key"), "buckets")
    sets = whole_sets(docs, met.select("node").distinct().join(nodes, "node"), size)

    # the seeds that share most keys with a node; the others' pairs are left to the second step
    often = met.filter("node <> lead").groupBy("node", "lead").agg(F.count(F.lit(1)).alias("shared"))
    nearest = Window.partitionBy("node").orderBy(F.desc("shared"), "lead")
    stars = settle(often.withColumn("at", F.row_number().over(nearest)).filter(F.col("at") <= LEADS).select(F.col("lead").alias("cell"), "node"), "stars")
    plain = F.lit(-1).alias("place")
    links = linked(stars.select("cell", plain, F.col("cell").alias("node")).distinct(), stars.select("cell", plain, "node"),
                   sets.withColumn("root", F.col("node")), percent)
    roots = components(links)

    placed = met.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    sizes = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    main = (sizes.groupBy("key").agg(F.max(F.struct("size", "root")).alias("most"), F.count(F.lit(1)).alias("groups"))
            .filter("groups > 1").select("key", F.col("most.root").alias("main")))
    apart = settle(placed.join(main, "key").groupBy("node").agg(F.max(F.col("root") != F.col("main")).alias("stray")), "apart")
    if not apart.isEmpty():
        now = sets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        each = (apart.join(sets.select("node", "parts"), "node")
                .select("node", "stray", F.posexplode(F.slice("parts", 1, SIDE)).alias("place", "cell")))
        stray = each.filter("stray").select("cell", "place", "node")
        members = each.join(stray.select("cell").distinct(), "cell", "left_semi").select("cell", "place", "node")
        more = linked(stray, members, now, percent)
        if not more.isEmpty():
            roots = components(links.unionByName(more))

    named = nodes.select("node", "digest", "first").join(roots, "node", "left").select("digest", "first", F.coalesce("root", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = settle(named.join(smallest, "root").select("digest", "component_id"), "named")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (found.select("doc_id", "digest", "n").join(labels, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept")))

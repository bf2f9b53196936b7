"""Near-duplicates by SimHash and multi-index hashing.

A fingerprint has two segments of 32 bits, each the key of a table.  Two
fingerprints at two differing bits or fewer have at most one of them in the high
segment, or both there and none in the low one.  So the balls of radius one
around high segments and the low segments themselves are looked up, and matches
are verified on all 64 bits.  Of two segments one bit apart, one has the bit
clear: only clear bits are flipped, so each pair is met once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, settle, small_batches
from .graph import components

#: Hash seed, words of a shingle, differing bits of a link.
SEED, SHINGLE, DISTANCE = 42, 3, 2
#: Table entries under one segment from which links are found by shared centres instead of by pairs.
CROWD = 64
#: Shingles whose bits are counted at once.
BLOCK = 1 << 15


def fingerprint(text: str) -> int:
    """The signed 64-bit fingerprint of a text; zero where it has no words."""
    words = text.encode().lower().split()  # bytes: only A-Z and the six ASCII spaces count
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, BLOCK):
        some = words[start:start + BLOCK + SHINGLE - 1]
        joined = b" ".join(some)
        ends = np.cumsum([len(w) + 1 for w in some]) - 1
        begins = np.concatenate(([0], ends[:-1] + 1))
        k = min(SHINGLE, len(some))
        spans = zip(begins[:len(some) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` for every row of ``docs``."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(t.as_py()) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])

    source = id_and_text(docs)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, fp bigint")


def links(codes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp``.

    Pairs are listed where the segment looked up has at most ``crowd`` entries.
    Fingerprints that meet in a larger one are linked through shared centres: two
    codes at most two bits apart share a code at most one bit from either, so each
    code lists its 65 centres and is linked to the smallest code of each.  Those
    links reach every such pair, and grow with the codes, not with their square.
    """
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(0xFFFFFFFF)
    entry = F.array(F.struct(F.lit(0).alias("seg"), high.alias("key")), F.struct(F.lit(1).alias("seg"), low.alias("key")))
    entries = codes.select("fp", F.explode(entry).alias("e")).select("fp", "e.seg", "e.key")
    flips = (codes.select("fp", high.alias("key"), F.explode(F.sequence(F.lit(0), F.lit(31))).alias("bit"))
             .withColumn("mask", F.expr("shiftleft(1L, bit)")).filter(F.col("key").bitwiseAND(F.col("mask")) == 0)
             .select("fp", F.lit(0).alias("seg"), F.col("key").bitwiseOR(F.col("mask")).alias("key")))
    probes = entries.unionByName(flips)
    crowded = settle(entries.groupBy("seg", "key").count().filter(F.col("count") > crowd).select("seg", "key"), "crowded")
    table = entries.join(crowded, ["seg", "key"], "left_anti").withColumnRenamed("fp", "other")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE
    pairs = (probes.join(table, ["seg", "key"]).select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b"))
             .filter("a <> b").filter(near))
    if crowded.isEmpty():
        return pairs
    met = probes.join(crowded, ["seg", "key"], "left_semi").select("fp").distinct()
    centres = met.select("fp", F.expr("explode(concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))))").alias("centre"))
    first = centres.groupBy("centre").agg(F.min("fp").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("centre", "first")
    stars = centres.join(first, "centre").select(F.col("first").alias("a"), F.col("fp").alias("b")).filter("a <> b").filter(near)
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Null texts are empty; texts without words have fingerprint zero and link like
    others.  Repeated rows come out once each.  A row without id gets its
    component, whose name is the smallest id that is not null (null if there is
    none).  Extra columns are not read; an empty table gives no rows.
    """
    prints = settle(fingerprints(docs), "prints")
    codes = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "codes")
    roots = components(links(codes.select("fp"), crowd))
    named = codes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = settle(named.join(smallest, "root").select("fp", "component_id"), "named")
    return prints.join(labels, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """One document of each group, the one with the smallest id, with its columns.

    Rows without id belong to no group and stay; rows that repeat an id that stays stay too.
    """
    gone = near_duplicates(docs, crowd).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)

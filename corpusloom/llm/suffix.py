"""Repeated byte strings by sparse distributed prefix doubling.

A string of ``SPAN`` bytes repeats if it starts at two places.  Not every place is
ranked: each string picks, by its content alone, one place in it, its anchor, so
equal strings pick equal places.  Anchors are ranked by growing stretches of text
and leave as soon as their rank is unique:

* by the ``FIRST`` bytes that all of an anchor's strings share;
* by the whole stretch that its strings cover: where that repeats, all of them do;
* what is left, anchors at the edges of a repeat, up to the full ``SPAN``: in small
  groups of equal rank by common prefixes to the left and right of the anchor, in
  large ones by ranking cells of neighbouring strings and then single strings.

Ranks are 64-bit or 128-bit digests of content, which Spark groups and sorts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, settle, small_batches

SPAN, FIRST = 200, 64
#: Places that a string's anchor is picked from, and bytes that decide on it.
REACH, GRAM = SPAN - FIRST + 1, 8
#: Members of a group that are compared with each other; larger groups are ranked on, in cells of so many strings and then one by one.
CROWD, CELL = 64, 16
#: Text bytes that anchors are looked for in together.
PART = 1 << 18
FACTOR = np.uint64(0x9E3779B97F4A7C15)
LOW = np.uint64((1 << 20) - 1)


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors of a text, and the first and last start of the strings that picked each.

    A string's anchor is the place of the smallest hashed ``GRAM`` among its first
    ``REACH``, the leftmost of equals: a minimum over a sliding window, by doubling.
    """
    strings, out = len(text) - SPAN + 1, []
    for base in range(0, strings, PART):
        count = min(PART, strings - base)
        data = np.frombuffer(text, np.uint8)[base:base + count + REACH + GRAM - 2]
        code = np.lib.stride_tricks.as_strided(data[:GRAM].view("<u8"), (len(data) - GRAM + 1,), (1,)) * FACTOR
        code ^= code >> np.uint64(32)
        code *= FACTOR
        code = code & ~LOW | np.arange(len(code), dtype=np.uint64)
        low, size = code, 1
        while 2 * size <= REACH:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        low = np.minimum(low[:count], low[REACH - size:REACH - size + count])
        at = (low & LOW).astype(np.int64)
        cuts = np.flatnonzero(at[1:] != at[:-1]) + 1
        begin, end = np.concatenate(([0], cuts)), np.concatenate((cuts, [count])) - 1
        out.append(np.stack((at[begin], begin, end)) + base)
    return tuple(np.concatenate(out, axis=1)) if out else (np.zeros(0, np.int64),) * 3


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def marks(texts: DataFrame) -> DataFrame:
    """``h, e, key, first, last, at``: each anchor's two ranks, its strings, and its place after the first of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, one, two, cols = [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                text = text.encode()
                place, first, last = anchors(text)
                for a, f, z in zip(place.tolist(), first.tolist(), last.tolist(), strict=True):
                    one.append(xxhash.xxh3_64_intdigest(text[a:a + FIRST]))
                    two.append(xxhash.xxh3_64_intdigest(text[f:z + SPAN], a - f))
                row.append(np.full(len(place), i))
                cols.append(np.stack((first, last, place - first)))
            row = np.concatenate(row) if row else np.zeros(0, np.int64)
            first, last, at = np.concatenate(cols, axis=1) if cols else (np.zeros(0, np.int64),) * 3
            yield pa.RecordBatch.from_arrays([_signed(one), _signed(two), batch.column(0).take(pa.array(row)), pa.array(first), pa.array(last),
                                              pa.array(at.astype(np.int32))], ["h", "e", "key", "first", "last", "at"])

    return texts.mapInArrow(run, "h long, e long, key binary, first long, last long, at int")


def _prefix(block: np.ndarray, sizes: np.ndarray, i: int) -> np.ndarray:
    """How many leading bytes each row of ``block`` shares with row ``i``."""
    differ = np.ones((len(block), block.shape[1] + 1), bool)
    differ[:, :-1] = block != block[i]
    return np.minimum(differ.argmax(1), np.minimum(sizes, sizes[i]))


def shared_strings(members: list[dict]) -> Iterator[tuple[bytes, int, int]]:
    """``key, first, last`` of the strings of single members that another member holds too."""
    at, size = np.array([m["at"] for m in members]), np.array([len(m["piece"]) for m in members])
    left, right = np.zeros((len(members), at.max()), np.uint8), np.zeros((len(members), (size - at).max()), np.uint8)
    for i, m in enumerate(members):
        piece = np.frombuffer(m["piece"], np.uint8)
        left[i, :at[i]] = piece[:at[i]][::-1]
        right[i, :size[i] - at[i]] = piece[at[i]:]
    for i, m in enumerate(members):
        if m["sole"]:
            back, ahead = _prefix(left, at, i), _prefix(right, size - at, i)
            # strings that reach back no more than ``back`` and ahead no more than ``ahead``
            most, least = np.minimum(back, at[i]), np.maximum(SPAN - ahead, at[i] - (m["last"] - m["first"]))
            some = (most >= least) & (np.arange(len(members)) != i)
            for o, p in set(zip(least[some].tolist(), most[some].tolist(), strict=True)):
                yield m["key"], m["first"] + int(at[i]) - p, m["first"] + int(at[i]) - o


def repeated(docs: DataFrame) -> DataFrame:
    """``key, first, last``: of each distinct text (``key`` is its digest), ranges of starts of repeated strings."""
    spark = docs.sparkSession
    texts = docs.select("key", "text")
    found = marks(texts)
    ranks = settle(found.groupBy("h").agg(F.count(F.lit(1)).alias("n"), (F.min("e") != F.max("e")).alias("mixed"))
                   .filter("n > 1").select("h", "mixed"), "ranks")
    held = settle(found.join(ranks, "h"), "held")
    mixed = held.filter("mixed")
    classes = settle(mixed.groupBy("h", "e").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "first", "last", "at")).alias("r")), "classes")
    sure = held.filter("NOT mixed").select("key", "first", "last").unionByName(
        mixed.join(classes.filter("n > 1").select("h", "e"), ["h", "e"]).select("key", "first", "last"))
    # one member stands for its class, marked where it is the only one
    crowds = classes.groupBy("h").agg((F.count(F.lit(1)) > CROWD).alias("crowd"))
    wanted = (classes.join(crowds, "h").select("r.key", F.struct("h", "r.first", "r.last", "r.at", (F.col("n") == 1).alias("sole"), "crowd").alias("m"))
              .groupBy("key").agg(F.collect_list("m").alias("members")))
    one_text = texts.groupBy("key").agg(F.first("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, members in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                text = text.encode()
                rows += [m | {"key": key, "piece": text[m["first"]:m["last"] + SPAN]} for m in members]
            yield pa.RecordBatch.from_pylist(rows, pieces)

    pieces = pa.schema([("h", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("at", pa.int32()), ("sole", pa.bool_()),
                        ("crowd", pa.bool_()), ("key", pa.binary()), ("piece", pa.binary())])
    shape = "h long, first long, last long, at int, sole boolean, crowd boolean, key binary, piece binary"
    parts = settle(one_text.join(wanted, "key").select("key", "text", "members").mapInArrow(cut, shape), "pieces")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for members in batch.column(0).to_pylist() for r in shared_strings(members)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
                                              pa.array([r[2] for r in rows], pa.int64())], ["key", "first", "last"])

    few = (parts.filter("NOT crowd").groupBy("h").agg(F.collect_list(F.struct("key", "first", "last", "at", "sole", "piece")).alias("members"))
           .select("members").mapInArrow(compare, "key binary, first long, last long"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, first, last, sole, piece in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                n = last - first + 1
                digests = [xxhash.xxh3_128_intdigest(piece[i:i + SPAN]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [_signed([d >> 64 for d in digests]), _signed([d & (1 << 64) - 1 for d in digests]), pa.array([key] * n, pa.binary()),
                     pa.array(range(first, last + 1), pa.int64()), pa.array([sole] * n)], ["one", "two", "key", "first", "sole"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for m in batch.to_pylist():
                anchor, piece = m["first"] + m["at"], m["piece"]
                for cell in range((anchor - m["last"]) // CELL, m["at"] // CELL + 1):
                    first, last = max(m["first"], anchor - cell * CELL - CELL + 1), min(m["last"], anchor - cell * CELL)
                    core = m["at"] - cell * CELL  # what all strings of the cell share, held or not
                    some = piece[first - m["first"]:last - m["first"] + SPAN]
                    rows.append((m["h"], xxhash.xxh3_64_intdigest(piece[core:core - CELL + 1 + SPAN], cell),
                                 xxhash.xxh3_64_intdigest(some, anchor - first), m["key"], first, last, m["sole"], some))
            cols = list(zip(*rows, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), _signed(cols[1]), _signed(cols[2]), pa.array(cols[3], pa.binary()),
                                              pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64()), pa.array(cols[6], pa.bool_()),
                                              pa.array(cols[7], pa.binary())], ["h", "core", "e", "key", "first", "last", "sole", "piece"])

    # the same two ranks again, over cells of strings that share more
    cells = (parts.filter("crowd").select("h", "key", "first", "last", "at", "sole", "piece")
             .mapInArrow(split, "h long, core long, e long, key binary, first long, last long, sole boolean, piece binary"))
    closer = settle(cells.groupBy("h", "core").agg(F.count(F.lit(1)).alias("n"), (F.min("e") != F.max("e")).alias("mixed"))
                    .filter("n > 1").select("h", "core", "mixed"), "closer")
    kinds = settle(cells.join(closer.filter("mixed"), ["h", "core"]).groupBy("h", "core", "e").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "first", "last", "sole", "piece")).alias("r")), "kinds")
    alike = closer.filter("NOT mixed").select("h", "core", F.lit(None).cast("long").alias("own")).unionByName(
        kinds.filter("n > 1").select("h", "core", F.col("e").alias("own")))
    whole = (cells.filter("sole").drop("piece", "sole").join(alike, ["h", "core"]).filter("own IS NULL OR own = e").select("key", "first", "last"))
    strings = (kinds.select("r.key", "r.first", "r.last", (F.col("r.sole") & (F.col("n") == 1)).alias("sole"), "r.piece")
               .mapInArrow(each, "one long, two long, key binary, first long, sole boolean"))
    again = strings.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("one", "two")
    many = whole.unionByName(strings.filter("sole").join(again, ["one", "two"]).select("key", "first", F.col("first").alias("last")))
    return sure.unionByName(few).unionByName(many).distinct()


def _tidy(spark: SparkSession) -> None:
    """Lets Spark drop shuffle files as soon as the step that wrote them has ended."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def remaining(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` for every row of ``docs``.

    ``kept`` are the bytes that stay; a cut may fall inside a character.  Each byte goes that lies in a string of ``SPAN`` bytes which starts anywhere else
    too, judged on the input.  Null texts are empty; texts shorter than ``SPAN`` stay
    whole; a text that occurs twice goes whole if it is as long.  Texts are known by
    their digest, so repeated rows and rows without id are fine.  Extra columns are
    not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    _tidy(spark)
    source = id_and_text(docs).withColumn("key", F.unhex(F.md5("text")))
    kind = source.schema["doc_id"].dataType.simpleString()
    ranges = repeated(source).groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, some in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                text, kept, at, spans, gone = text.encode(), [], 0, 0, 0
                end = -1
                for r in sorted(some or (), key=lambda r: r["first"]):
                    if r["first"] > end:  # a new run; what lies before it stays
                        kept.append(text[at:r["first"]])
                        spans += 1
                        gone -= r["first"]
                        end = r["first"]
                    else:
                        gone -= end
                    end = max(end, r["last"] + SPAN)
                    gone += end
                    at = end
                kept.append(text[at:])
                rows.append((len(text), gone, spans, b"".join(kept)))
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return (source.join(ranges, "key", "left").select("doc_id", "text", "ranges")
            .mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"))


def digest(rows: DataFrame) -> DataFrame:
    """``kept`` replaced by ``kept_sha256``."""
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``: what ``remaining`` gives, as digests."""
    return digest(remaining(docs))

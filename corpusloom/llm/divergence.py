"""Source divergence audit by a recount through minimal perfect hashes.

The first pass counts the documents of every term exactly and keeps the frequent
terms.  They are cut into shards of bounded size by their hash; a task builds each
shard's minimal perfect hash.  The second pass gets the shards by broadcast, as many
at a time as fit a fixed bound, so a vocabulary of any size takes more passes but no
more memory; it looks terms up, checks the string stored at the slot, and counts into
dense slots per group.  Groups are then compared with each other and with their whole
language on dense blocks of slots, in whole numbers.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, groupby, repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, small_batches
from .perfecthash import PerfectHash, hashes

#: Fewest documents of a kept term, unit of shares, last rank of terms.
MIN_DOCS, UNIT, TOP = 3, 1_000_000_000, 200
#: Terms a shard has on average; bytes of terms that one pass broadcasts at most.
SHARD_TERMS, BROADCAST_BYTES = 1 << 15, 64 << 20
#: Slots of a block that groups are compared on; slots a task holds; distinct terms a task counts documents of.
BLOCK, HELD, REMEMBERED = 1 << 12, 1 << 25, 500_000
#: A term in lower case: everything from U+0080 on and the letters, in UTF-8.
TERM = re.compile(rb"[a-z\x80-\xff]+")


def terms(text: str) -> list[bytes]:
    """The terms of a text, A-Z lowered, in order."""
    return TERM.findall(text.encode().lower())


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def frequent(docs: DataFrame, at_least: int = MIN_DOCS) -> DataFrame:
    """``lang, term`` of the terms that at least so many rows of a language hold."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def close() -> Iterator[pa.RecordBatch]:
            for lang, counted in seen.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counted), pa.string()), pa.array(list(counted), pa.binary()).cast(pa.string()),
                                                  pa.array(list(counted.values()), pa.int64())], ["lang", "term", "n"])
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.setdefault(lang, Counter()).update(set(terms(text)))
            if sum(map(len, seen.values())) > REMEMBERED:
                yield from close()
        yield from close()

    return (_rows(docs).select("lang", "text").mapInArrow(run, "lang string, term string, n bigint")
            .groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= at_least).select("lang", "term"))


def shards(kept: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """``lang, shard, shards, n, bytes, hashed``: the perfect hash of each shard of ``kept (lang, term)``."""
    wide = kept.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / shard_terms).alias("shards"))

    def run(table: pa.Table) -> pa.Table:
        held = [t.encode() for t in table.column("term").to_pylist()]
        packed = pickle.dumps(PerfectHash(held), pickle.HIGHEST_PROTOCOL)
        first = {c: table.column(c)[0].as_py() for c in ("lang", "shard", "shards")}
        return pa.Table.from_pylist([first | {"n": len(held), "bytes": len(packed), "hashed": packed}], schema)

    schema = pa.schema([("lang", pa.string()), ("shard", pa.int64()), ("shards", pa.int64()), ("n", pa.int64()), ("bytes", pa.int64()), ("hashed", pa.binary())])
    return (kept.join(wide, "lang").withColumn("shard", F.pmod(F.xxhash64("term"), "shards")).groupBy("lang", "shard")
            .applyInArrow(run, "lang string, shard long, shards long, n long, bytes long, hashed binary"))


class _Finder:
    """Slots of one language's terms among the shards of a pass; the terms it has found are remembered."""

    def __init__(self, held: dict[int, tuple[int, PerfectHash]], number: int) -> None:
        self.held, self.number, self.known = held, number, {}
        self.low = min(first for first, _ in held.values())
        self.size = max(first + len(hashed.strings) for first, hashed in held.values()) - self.low

    def slots(self, some: list[bytes]) -> np.ndarray:
        """Slots from ``low`` on, -1 for terms that no shard here holds."""
        new = list(set(some).difference(self.known))
        if new:
            keys = hashes(new)
            shard = keys.view(np.int64) % self.number
            for s, (first, hashed) in self.held.items():
                mine = np.flatnonzero(shard == s)
                if len(mine):
                    names = [new[i] for i in mine.tolist()]
                    found = hashed.slots(names, keys[mine]).tolist()
                    self.known.update((name, slot + first - self.low) for name, slot in zip(names, found, strict=True) if slot >= 0)
        return np.fromiter(map(self.known.get, some, repeat(-1)), np.int64, len(some))


def recount(docs: DataFrame, table: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, block: int = BLOCK, held: int = HELD) -> DataFrame:
    """``lang, source, block, n, slots, counts``: partial counts of the terms of ``shards`` in each group.

    Slots number the terms of a language, shard after shard; a row holds those of one
    block that occur, as numbers from the block's start (32 bits) and their counts (64
    bits), and ``n``, the sum of these.
    """
    spark = docs.sparkSession
    small_batches(spark)
    source = _rows(docs)
    # one row for so many thousand terms; the hashes themselves come a pass at a time
    plan, passes, room, first = [r.asDict() for r in table.select("lang", "shard", "shards", "n", "bytes").orderBy("lang", "shard").collect()], [], 0, {}
    for row in plan:
        row["first"] = first.get(row["lang"], 0)
        first[row["lang"]] = row["first"] + row["n"]
        if not passes or room + row["bytes"] > broadcast_bytes:
            passes.append([])
            room = 0
        room += row["bytes"]
        passes[-1].append(row)
    out = None
    for rows in passes:
        place = {(r["lang"], r["shard"]): r for r in rows}
        ends = [(r["lang"], r["shard"]) for r in (rows[0], rows[-1])]
        here = F.struct("lang", "shard").between(*(F.struct(F.lit(a), F.lit(b).cast("long")) for a, b in ends))
        packed = [(place[r["lang"], r["shard"]], bytes(r["hashed"])) for r in table.filter(here).select("lang", "shard", "hashed").toLocalIterator()]
        counted = settle(source.mapInArrow(_counter(spark.sparkContext.broadcast(packed), block, held), CELLS), "cells")
        out = counted if out is None else out.unionByName(counted)
    return spark.createDataFrame([], CELLS) if out is None else out


#: Columns of partial counts.
CELLS = "lang string, source string, block bigint, n bigint, slots binary, counts binary"


def _counter(shared, width: int, most: int):
    """Counts the rows of a task into dense slots per group; holds ``most`` slots, or one batch's groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang: dict[str, tuple[int, dict]] = {}
        for row, packed in shared.value:
            by_lang.setdefault(row["lang"], (row["shards"], {}))[1][row["shard"]] = (row["first"], pickle.loads(packed))
        finders = {lang: _Finder(held, number) for lang, (number, held) in by_lang.items()}
        dense: dict[tuple[str, str], np.ndarray] = {}
        counted = 0

        def close() -> Iterator[pa.RecordBatch]:
            for (lang, source), slots in dense.items():
                some = np.flatnonzero(slots)
                if not len(some):
                    continue
                counts, at = slots[some], some + finders[lang].low
                blocks, cuts = np.unique(at // width, return_index=True)
                ends = [*cuts[1:].tolist(), len(at)]
                within = (at % width).astype("<u4")
                rows = [(lang, source, b, int(counts[i:j].sum()), within[i:j].tobytes(), counts[i:j].astype("<i8").tobytes())
                        for b, i, j in zip(blocks.tolist(), cuts.tolist(), ends, strict=True)]
                yield _batch(rows, schema)
            dense.clear()

        schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("slots", pa.binary()), ("counts", pa.binary())])
        for batch in batches:
            grouped: dict[str, list[tuple[str, list[bytes]]]] = {}
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if lang in finders:
                    grouped.setdefault(lang, []).append((source, terms(text)))
            for lang, rows in grouped.items():
                slots = finders[lang].slots(list(chain.from_iterable(some for _, some in rows)))
                rows = sorted(zip((source for source, _ in rows), np.split(slots, np.cumsum([len(some) for _, some in rows])[:-1]), strict=True), key=itemgetter(0))
                for source, some in groupby(rows, itemgetter(0)):
                    if (lang, source) not in dense:
                        if sum(map(len, dense.values())) + finders[lang].size > most:
                            yield from close()
                        dense[lang, source] = np.zeros(finders[lang].size, np.uint32)
                    found = np.concatenate([s for _, s in some])
                    np.add.at(dense[lang, source], found[found >= 0], np.uint32(1))
                    counted += len(found)
            if counted >> 31:  # before a slot can be full
                yield from close()
                counted = 0
        yield from close()

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), schema.types, strict=True)], schema.names)


def share(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """``1 + floor(UNIT * (counts + 1) / total)`` in whole numbers, digit by digit: nothing exceeds 64 bits."""
    whole, rest = np.divmod(counts + 1, total)
    high, rest = np.divmod(rest * 100_000, total)
    return 1 + whole * UNIT + high * 10_000 + rest * 10_000 // total


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _comparer(width: int):
    """Pairs of sources summed over a block of slots, and the block's terms that may be among a source's first ``TOP``.

    Rows come sorted by block, each block's first with the sources and totals of its
    language; only one block's counts are held.
    """
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("other", pa.string()), ("slot", pa.int64()), ("value", pa.int64())])

    def compared(lang: str, block: int, kept: int, names: list[str], totals: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        p = share(counts, (totals + kept)[:, None])
        q = share(counts.sum(0), int(totals.sum()) + kept)
        at, other, slot, value = [], [], [], []
        for a in range(len(names)):
            rest = np.flatnonzero(np.arange(len(names)) != a)
            over = np.flatnonzero((counts[a] > 0) & (p[a] > q))
            far = distance(p[a][over], q[over])
            if len(over) > TOP:
                stay = far >= np.partition(far, -TOP)[-TOP]
                over, far = over[stay], far[stay]
            at.append(np.full(len(rest) + len(over), a))
            other.append(np.concatenate((rest, np.full(len(over), -1))))
            slot.append(np.concatenate((np.full(len(rest), -1), over + block * width)))
            value.append(np.concatenate((distance(p[a], p[rest]).sum(1), far)))
        at, other, slot, value = map(np.concatenate, (at, other, slot, value))
        known = pa.array(names, pa.string())
        return pa.RecordBatch.from_arrays([
            pa.array([lang]).take(pa.array(np.zeros(len(at), np.int64))), known.take(pa.array(at)), known.take(pa.array(other, mask=other < 0)),
            pa.array(slot, mask=slot < 0), pa.array(value)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = counts = number = None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("lang", "block", "kept", "sources", "source", "slots", "counts")), strict=True)
            for lang, block, kept, sources, source, slots, held in rows:
                if sources is not None:
                    if now:
                        yield compared(*now, counts)
                    names = [x["source"] for x in sources]
                    now, number = (lang, block, kept, names, np.array([x["total"] for x in sources], np.int64)), {n: i for i, n in enumerate(names)}
                    counts = np.zeros((len(names), min(width, kept - block * width)), np.int64)
                else:
                    counts[number[source]][np.frombuffer(slots, "<u4")] += np.frombuffer(held, "<i8")
        if now:
            yield compared(*now, counts)

    return run


def audit(docs: DataFrame, shard_terms: int = SHARD_TERMS, broadcast_bytes: int = BROADCAST_BYTES, block: int = BLOCK, held: int = HELD) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group of ``docs``.

    Null ``lang``, ``source`` and ``text`` are empty strings.  A group without terms,
    and a language that keeps none, still has its pairs; a language of one source has
    none.  Repeated rows count each time; extra columns are not read; an empty table
    gives no rows.
    """
    kept = settle(frequent(docs), "terms")
    table = settle(shards(kept, shard_terms), "shards")
    cells = recount(docs, table, broadcast_bytes, block, held)
    groups = _rows(docs).select("lang", "source").distinct()
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    size = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    totals = settle(groups.join(sums, ["lang", "source"], "left").join(size, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept")), "totals")
    langs = totals.groupBy("lang").agg(F.first("kept").alias("kept"), F.sort_array(F.collect_list(F.struct("source", "total"))).alias("sources"))
    heads = langs.filter("kept > 0").select("lang", F.explode(F.expr(f"sequence(0L, (kept - 1) div {block})")).alias("block"), "kept", "sources")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = settle(heads.unionByName(cells.drop("n"), allowMissingColumns=True).repartition(parts, "lang", "block")
                   .sortWithinPartitions("lang", "block", F.asc_nulls_first("source")).select("lang", "block", "kept", "sources", "source", "slots", "counts")
                   .mapInArrow(_comparer(block), "lang string, source string, other string, slot bigint, value bigint"), "compared")

    summed = found.filter("other IS NOT NULL").groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    all_pairs = (langs.select("lang", F.explode("sources.source").alias("source"), F.col("sources.source").alias("others"))
                 .select("lang", "source", F.explode("others").alias("other")).filter("source <> other"))
    pairs = all_pairs.join(summed, ["lang", "source", "other"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), F.coalesce("value", F.lit(0)).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = (found.filter("slot IS NOT NULL").join(_names(table), ["lang", "slot"])
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value"))
    return (pairs.withColumn("rank", F.row_number().over(order))
            .unionByName(best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)))


def _names(table: DataFrame) -> DataFrame:
    """``lang, slot, term`` of the terms that the shards hold."""
    before = Window.partitionBy("lang").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = table.select("lang", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, first, packed in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                held = pickle.loads(packed).strings
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(held), pa.string()), pa.array(np.arange(first, first + len(held)), pa.int64()),
                                                  pa.array(held, pa.binary()).cast(pa.string())], ["lang", "slot", "term"])

    return table.select("lang", "shard", "hashed").join(firsts, ["lang", "shard"]).select("lang", "first", "hashed").mapInArrow(run, "lang string, slot bigint, term string")

"""Benchmark decontamination by q-gram lemma filtering.

Benchmark texts are cut into windows.  A region of a document within ``k`` edits
of a window of ``m`` characters shares at least ``m - q + 1 - k * q`` q-grams with
it, all on neighbouring diagonals.  Shared q-grams are counted in overlapping
bands of diagonals; bands that reach the bound are verified by banded alignment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, small_batches

#: Bytes of a q-gram; bytes of a window, and from one window to the next; edits allowed per window byte.
#: Any 84 bytes of a benchmark text, some 14 words, hold a whole window.
Q, WINDOW, STEP, RATE = 8, 72, 12, 3 / 32
#: Benchmark bytes that one pass over the documents compares with.
BLOCK_BYTES = 1 << 20
#: Document bytes looked at together.
PIECE = 1 << 19
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def plain(text: str) -> bytes:
    """Lower case, single spaces."""
    return b" ".join(text.lower().encode().split())


def grams(text: bytes) -> np.ndarray:
    """All q-grams as numbers, one per position."""
    if len(text) < Q:
        return np.zeros(0, "<u8")
    data = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.as_strided(data[:Q].view("<u8"), (len(text) - Q + 1,), (1,)).copy()


def within(window: bytes, region: bytes, k: int) -> bool:
    """Whether some part of ``region`` is at most ``k`` edits from ``window``.

    Free ends in the region; only diagonals that ``k`` edits can reach are filled.
    """
    if window in region:
        return True
    m, spare = len(window), len(region) - len(window)
    low, high = -k, spare + k
    if high < low:
        return False
    reg = np.frombuffer(region, np.uint8)
    width = high - low + 1
    cols = np.arange(width) + low  # column of a diagonal in row 0
    steps = np.arange(width)
    row = np.where((cols >= 0) & (cols <= len(region)), 0, k + 1)
    for i, letter in enumerate(window, 1):
        at = cols + i
        inside = (at >= 1) & (at <= len(region))
        same = np.full(width, k + 1)
        same[inside] = row[inside] + (reg[at[inside] - 1] != letter)
        above = np.append(row[1:], k + 1) + 1
        best = np.minimum(same, above)
        best[at == 0] = min(i, k + 1)
        best = np.minimum.accumulate(best - steps) + steps  # insertions run along the row
        row = np.where((at >= 0) & (at <= len(region)), np.minimum(best, k + 1), k + 1)
        if row.min() > k:
            return False
    return bool(row.min() <= k)


class Index:
    """Windows of a block of benchmark texts and where their q-grams lie."""

    def __init__(self, items: list[tuple[object, bytes]]) -> None:
        self.names, self.windows, self.owner = [n for n, _ in items], [], []
        self.short = [(i, t) for i, (_, t) in enumerate(items) if 0 < len(t) < Q]
        for i, (_, text) in enumerate(items):
            if len(text) >= Q:
                starts = sorted({*range(0, max(1, len(text) - WINDOW + 1), STEP), max(0, len(text) - WINDOW)})
                for s in starts:
                    self.windows.append(text[s:s + WINDOW])
                    self.owner.append(i)
        sizes = np.array([len(w) for w in self.windows], np.int64)
        # short windows allow fewer edits, down to none, so that the bound stays positive
        self.edits = np.minimum((sizes * RATE).astype(np.int64), np.maximum((sizes - Q) // Q, 0))
        self.bound = sizes - Q + 1 - self.edits * Q
        codes = [grams(w) for w in self.windows]
        flat = np.concatenate(codes) if codes else np.zeros(0, "<u8")
        owner = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.codes, begin = np.unique(flat[order], return_index=True)
        self.begin = np.append(begin, len(flat))
        self.window_of, self.place_of = owner[order], place[order]
        self.bits = np.zeros(1 << 22, bool)
        self.bits[self._slot(self.codes)] = True
        self.least = int(self.bound.min(initial=1 << 30))
        self.span = int((sizes + 2 * self.edits).max(initial=0))
        self.region = int((sizes + self.edits).max(initial=0)) - Q + 1

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes * FACTOR >> np.uint64(42)).astype(np.int64)

    def candidates(self, text: bytes) -> Iterator[tuple[int, int]]:
        """``window, first diagonal`` of every band of diagonals that reaches its bound."""
        step = PIECE - self.span
        for start in range(0, max(1, len(text) - self.span), step):
            codes = grams(text[start:start + PIECE])
            if not len(codes):
                continue
            hit = self.bits[self._slot(codes)]
            # the hits of a match lie within one region: where no region around a hit has enough, nothing can match
            total = np.concatenate(([0], np.cumsum(hit, dtype=np.int32)))
            rich = total[np.minimum(np.arange(self.region, len(total) + self.region - 1), len(hit))] - total[:-1] >= self.least
            at = np.flatnonzero(hit)
            seen = np.concatenate(([0], np.cumsum(rich, dtype=np.int32)))
            at = at[seen[at + 1] > seen[np.maximum(at + 1 - self.region, 0)]]
            if not len(at):
                continue
            spot = np.searchsorted(self.codes, codes[at])
            spot[spot == len(self.codes)] = 0
            true = self.codes[spot] == codes[at]
            at, spot = at[true], spot[true]
            times = self.begin[spot + 1] - self.begin[spot]
            where = np.repeat(self.begin[spot], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            window, place = self.window_of[where], self.place_of[where]
            diagonal = np.repeat(at, times) + start - place + WINDOW  # never negative
            wide = self.edits[window] + 1
            band = diagonal // wide
            # bands are two steps wide and overlap by one: each hit counts in two
            key = np.concatenate(((window << 30) + band, (window << 30) + np.maximum(band - 1, 0)))
            # counts by hash first: they are never too low, and few bands are left to count exactly
            size = max(10, (4 * len(key)).bit_length())
            slot = (key.astype(np.uint64) * FACTOR >> np.uint64(64 - size)).astype(np.int64)
            many = np.bincount(slot, minlength=1 << size)[slot] >= self.bound[key >> 30]
            if not many.any():
                continue
            one = np.unique(key[many] * WINDOW + np.concatenate((place, place))[many]) // WINDOW
            keys, count = np.unique(one, return_counts=True)
            window, band = keys >> 30, keys & (1 << 30) - 1
            for w, b in zip(window[count >= self.bound[window]].tolist(), band[count >= self.bound[window]].tolist(), strict=True):
                yield w, b * int(self.edits[w] + 1) - WINDOW

    def found(self, text: bytes) -> list[object]:
        """Names of the items of which a window lies in ``text``."""
        out = {i for i, t in self.short if b" " + t + b" " in b" " + text + b" "}
        if len(self.codes):
            for w, diagonal in self.candidates(text):
                k = int(self.edits[w])
                if self.owner[w] not in out and within(
                        self.windows[w], text[max(0, diagonal - k):diagonal + 2 * (k + 1) + len(self.windows[w]) + k], k):
                    out.add(self.owner[w])
        return [self.names[i] for i in sorted(out)]


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, bytes]]]:
    """The benchmark's distinct texts in blocks of bounded size, smallest ``item_id`` first."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).orderBy("item_id", "text")
    held, size = [], 0
    for row in items.toLocalIterator():
        held.append((row["item_id"], plain(row["text"])))
        size += len(held[-1][1])
        if size >= BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def matches(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (``doc_id`` by default) and ``items``, the ids found in each row of ``docs``.

    Each block of the benchmark adds its finds to the same rows, which are settled
    before the next one, so a task and the driver hold one block at a time.  Texts are compared in lower
    case with single spaces.  Items under ``Q`` bytes count as whole words; empty
    items and documents match nothing, and null texts are empty.  Items that repeat
    are all named.  Rows repeat as they came; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    out = docs.select(*[docs[c] for c in keep or ["doc_id"]], F.coalesce(docs["text"], F.lit("")).alias("_text"))
    kind = benchmark.schema["item_id"].dataType
    held = out.withColumn("items", F.array().cast(f"array<{kind.simpleString()}>"))
    for number, items in enumerate(blocks(benchmark)):
        held = (settle(held, "matches") if number else held).mapInArrow(_look(items), held.schema)
    return held.drop("_text")


def _look(items: list[tuple[object, bytes]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items)
        for batch in batches:
            t, i = batch.schema.get_field_index("_text"), batch.schema.get_field_index("items")
            before = batch.column(i).to_pylist()
            now = [b + index.found(plain(text)) for b, text in zip(before, batch.column(t).to_pylist(), strict=True)]
            yield batch.set_column(i, batch.schema.field(i), pa.array(now, batch.schema.field(i).type))

    return run


def flag(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, contaminated, n_items, items`` for every row of ``docs`` (see :func:`matches`)."""
    return matches(docs, benchmark).select("doc_id", (F.size("items") > 0).alias("contaminated"),
                                           F.size("items").cast("long").alias("n_items"), "items")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark text, with the columns they came with.

    Empty and null texts hold none; repeated rows and rows without id are looked at each on their own.
    """
    plain_names = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    carried = plain_names.select(*plain_names.columns, plain_names[f"c{docs.columns.index('text')}"].alias("text"))
    found = matches(carried, benchmark, plain_names.columns)
    return found.filter(F.size("items") == 0).drop("items").toDF(*docs.columns)

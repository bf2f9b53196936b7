"""Substring dedup by sliding sentence spans.

Texts are cut into sentences, and sentences of more than ``LONG`` words into clauses:
after a clause mark, and after words whose hash says so, which cuts the same words alike
wherever they stand.  A run is at least ``MIN_SENTENCES`` of these
in a row with ``MIN_WORDS`` words together.  Every run that repeats is covered by the
shortest runs that begin in it and the shortest that end in it, which repeat as well;
so at each sentence these two are hashed over their words, joined globally by hash, and
the sentences of every run that is not the first with its hash go.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, small_batches

#: Sentences and words of a run; words of a sentence or clause at most; one word in so many ends a clause.
MIN_SENTENCES, MIN_WORDS, LONG, ENDS = 2, 15, 16, 8
#: Runs a task holds to find those that repeat in it.
HELD = 1 << 19
#: What orders equal runs; rows that share an id and a text are one document.
PLACE = ("doc_id", "mark", "place")
#: A sentence ends with its mark and the white space after it, or with a line.
BREAK = re.compile(rb"(?<=[.!?])[\x20\x09-\x0D]+|[\x20\x09-\x0D]*\n[\x20\x09-\x0D]*")
WORD = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")
#: Odd multipliers of the two sums that make a run's hash, and their inverses.
STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
BACK = np.array([pow(int(s), -1, 1 << 64) for s in STEPS], np.uint64)


def _clauses(sentence: bytes, words: list[bytes]) -> Iterator[tuple[bytes, list[bytes]]]:
    """The clauses of a long sentence; those without an end of their own are cut after ``LONG`` words."""
    ends = [m.end() for m in WORD.finditer(sentence)]
    ends[-1] = len(sentence)
    at = begin = 0
    for stop in [i for i, w in enumerate(words, 1) if w[-1] in b",;:" or zlib.crc32(w) % ENDS == 0 or i == len(words)]:
        while at < stop:
            to = min(stop, at + LONG)
            yield sentence[begin:ends[to - 1]], words[at:to]
            at, begin = to, ends[to - 1]


def sentences(text: bytes) -> list[tuple[bytes, list[bytes]]]:
    """The sentences and clauses, white space included, each with its words; joined they give the text."""
    out: list[tuple[bytes, list[bytes]]] = []
    start = 0
    for end in [*(m.end() for m in BREAK.finditer(text)), len(text)]:
        if start < end:
            part = text[start:end]
            words = part.split()
            if len(words) > LONG:
                out += _clauses(part, words)
            else:
                out.append((part, words))
            start = end
    return out


def _powers(base: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` powers of both numbers."""
    known = _known.get(int(base[0]))
    if known is None or len(known) < n:
        known = np.ones((max(n, 1024), 2), np.uint64)
        known[1:] = base
        known = _known[int(base[0])] = np.cumprod(known, axis=0, dtype=np.uint64)
    return known[:n]


_known: dict[int, np.ndarray] = {}


def spans(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``first, last, hash`` of the shortest runs that begin or end at each sentence.

    ``first`` is the byte a run begins at, ``last`` the one after its end; a hash is two
    numbers, of which 96 bits are used.
    """
    parts = sentences(text)
    n = len(parts)
    reach = np.concatenate(([0], np.cumsum([len(w) for _, w in parts], dtype=np.int64)))
    at = np.arange(n)
    # the first end that gives enough words and sentences, and the last start that does
    ends = np.maximum(np.searchsorted(reach, reach[:-1] + MIN_WORDS), at + MIN_SENTENCES)
    starts = np.minimum(np.searchsorted(reach, reach[1:] - MIN_WORDS, "right") - 1, at + 1 - MIN_SENTENCES)
    some, full = np.diff(reach) > 0, n + 1
    first, last = some & (ends <= n), some & (starts >= 0)
    codes = np.unique(np.concatenate((at[first] * full + ends[first], starts[last] * full + at[last] + 1)))
    start, end = codes // full, codes % full
    marks = np.frombuffer(b"".join([xxhash.xxh3_128_digest(b" ".join(w)) for _, w in parts]), ">u8").astype(np.uint64).reshape(-1, 2)
    sums = np.concatenate((np.zeros((1, 2), np.uint64), np.cumsum(marks * _powers(STEPS, n), axis=0, dtype=np.uint64)))
    offset = np.concatenate(([0], np.cumsum([len(p) for p, _ in parts], dtype=np.int64)))
    return offset[start], offset[end], (sums[end] - sums[start]) * _powers(BACK, n + 1)[start]


def _source(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).withColumn("mark", F.hash("text"))


def _not_first(runs: pa.Table) -> np.ndarray:
    """Marks the rows that are not at the first place (``doc_id, mark, place``) with their hash in this table."""
    hashes = (runs.column("one").to_numpy(), runs.column("two").to_numpy())
    order = np.argsort(hashes[0])
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = hashes[0][order[1:]] == hashes[0][order[:-1]]
    some = order[same[1:] | same[:-1]]  # only rows whose hash another one has
    again = np.zeros(len(order), bool)
    if not len(some):
        return again
    few = runs.take(pa.array(some))
    place = pc.sort_indices(few, [(c, "ascending") for c in ("one", "two", *PLACE)]).to_numpy()
    one, two = (h[some][place] for h in hashes)
    new = np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
    lead = place[np.maximum.accumulate(np.where(new, np.arange(len(place)), 0))]
    for c in PLACE:
        column = few.column(c).combine_chunks()
        again[some[place]] |= pc.not_equal(column.take(pa.array(place)), column.take(pa.array(lead))).to_numpy(zero_copy_only=False)
    return again


def repeated(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, place`` of every run that is not the first of its kind.

    The first is the one in the smallest ``doc_id``, and there the earliest; ``mark``
    tells rows of one id and different texts apart; ``place`` is the run's first byte (times
    2^32) and its length.  What a task finds to repeat within its own rows is settled
    there and dealt out evenly; so a run that stands in very many documents reaches the
    global join once or a few times a task.
    """
    small_batches(docs.sparkSession)
    source = _source(docs).filter("doc_id IS NOT NULL")
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, dealt = [], 0, 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal held, rows, dealt
            table = pa.concat_tables(held)
            again = _not_first(table)
            one = table.column("one").to_numpy().copy()
            one[again] = (np.arange(dealt, dealt + int(again.sum()), dtype=np.uint64) * STEPS[0]).view(np.int64)
            dealt += int(again.sum())
            yield from table.set_column(3, "one", pa.array(one)).append_column("again", pa.array(again)).to_batches()
            held, rows = [], 0

        for batch in batches:
            at, place, marks = [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                first, last, mark = spans(text.encode())
                at.append(np.full(len(first), row))
                place.append(first << 32 | last - first)
                marks.append(mark)
            if not at:
                continue
            row_of, mark = pa.array(np.concatenate(at)), np.concatenate(marks).view(np.int64)
            held.append(pa.table([batch.column(0).take(row_of), batch.column(2).take(row_of), pa.array(np.concatenate(place)),
                                  pa.array(mark[:, 0].copy()), pa.array((mark[:, 1] >> 32).astype(np.int32))], ["doc_id", "mark", "place", "one", "two"]))
            rows += len(row_of)
            if rows >= HELD:
                yield from close()
        if held:
            yield from close()

    found = source.mapInArrow(run, f"doc_id {kind}, mark int, place long, one long, two int, again boolean")
    order = Window.partitionBy("one", "two").orderBy(*PLACE)
    return found.withColumn("rank", F.rank().over(order)).filter("again OR rank > 1").select("doc_id", "mark", "place")


def without(text: bytes, places: np.ndarray) -> tuple[bytes, int, int]:
    """What is left of a text without some runs, and how many sentences and words have gone."""
    parts = sentences(text)
    ends = np.cumsum([len(p) for p, _ in parts])
    first, last = places >> 32, (places >> 32) + (places & 0xFFFFFFFF)
    depth = np.zeros(len(parts) + 1, np.int64)
    np.add.at(depth, np.searchsorted(ends, first, "right"), 1)
    np.add.at(depth, np.searchsorted(ends, last) + 1, -1)
    gone = np.cumsum(depth)[:-1] > 0
    kept = b"".join(p for (p, _), g in zip(parts, gone, strict=True) if not g)
    return kept, int(gone.sum()), sum(len(w) for (_, w), g in zip(parts, gone, strict=True) if g)


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_removed, n_removed_words, kept_sha256, kept_text`` for every row of ``docs``.

    ``n_removed`` counts sentences, and clauses of long ones.  Nulls are empty texts and
    keep an empty text.  Rows that share an id and a text count as one document, whose
    runs do not repeat each other; all of them come out.  Rows without id stay whole and
    are not the first of anything.  Texts shorter than a run stay.  Extra columns are not
    read; an empty table gives no rows.
    """
    gone = repeated(docs).groupBy("doc_id", "mark").agg(F.collect_set("place").alias("places"))
    source = _source(docs)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, places in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                kept, sentences_gone, words_gone = text.encode(), 0, 0
                if places.is_valid:
                    kept, sentences_gone, words_gone = without(kept, places.values.to_numpy())
                rows.append((sentences_gone, words_gone, hashlib.sha256(kept).hexdigest(), kept.decode()))
            cols = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                                             ["doc_id", "n_removed", "n_removed_words", "kept_sha256", "kept_text"])

    return (source.join(gone, ["doc_id", "mark"], "left").select("doc_id", "text", "places")
            .mapInArrow(run, f"doc_id {kind}, n_removed long, n_removed_words long, kept_sha256 string, kept_text string"))

"""A minimal perfect hash of a set of strings, looked up by whole arrays.

Keys are dealt to a bit array twice their number; those alone on their bit are done,
the others go on to the next, smaller array.  A key's slot is the number of bits set
before its own.  A key that was never put in may land on a bit as well, so the slot's
own string decides.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Hash seed (that of Spark's ``xxhash64``), arrays at most; keys still not alone after them are found by name.
SEED, LEVELS = 42, 40
STEP, SPREAD = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


def hashes(strings: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(s, SEED) for s in strings], np.uint64)


def _spots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    x = keys + np.uint64((level + 1) * STEP % (1 << 64))
    x = (x ^ x >> np.uint64(32)) * SPREAD
    return (x ^ x >> np.uint64(29)) % np.uint64(size)


class PerfectHash:
    """Distinct strings, each with a slot from 0 to their number less one."""

    def __init__(self, strings: list[bytes]) -> None:
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        keys, place, slots, done = hashes(strings), np.arange(len(strings)), np.zeros(len(strings), np.int64), 0
        for level in range(LEVELS):
            if not len(keys):
                break
            size = max(64, 2 * len(keys))
            spots = _spots(keys, level, size)
            alone = np.bincount(spots.astype(np.int64), minlength=size) == 1
            words = np.packbits(np.pad(alone, (0, -size % 64)), bitorder="little").view("<u8")
            before = (np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words) + done).astype("<i8")
            self.levels.append((size, words, before))
            mine = alone[spots]
            slots[place[mine]] = self._rank(words, before, spots[mine])
            done += int(mine.sum())
            keys, place = keys[~mine], place[~mine]
        slots[place] = done + np.arange(len(place))
        self.rest = {strings[p]: int(slots[p]) for p in place.tolist()}
        self.strings: list[bytes] = [b""] * len(strings)
        for slot, string in zip(slots.tolist(), strings, strict=True):
            self.strings[slot] = string

    @staticmethod
    def _rank(words: np.ndarray, before: np.ndarray, spots: np.ndarray) -> np.ndarray:
        word, bit = (spots >> np.uint64(6)).astype(np.int64), spots & np.uint64(63)
        return before[word] + np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def slots(self, strings: list[bytes], keys: np.ndarray | None = None) -> np.ndarray:
        """The slot of each string, -1 for strings that were not put in."""
        keys = hashes(strings) if keys is None else keys
        out, left = np.full(len(strings), -1, np.int64), np.arange(len(strings))
        for level, (size, words, before) in enumerate(self.levels):
            if not len(left):
                break
            spots = _spots(keys[left], level, size)
            hit = (words[(spots >> np.uint64(6)).astype(np.int64)] >> (spots & np.uint64(63)) & np.uint64(1)).astype(bool)
            out[left[hit]] = self._rank(words, before, spots[hit])
            left = left[~hit]
        for i in left.tolist():
            out[i] = self.rest.get(strings[i], -1)
        held = self.strings
        return np.array([s if s >= 0 and held[s] == t else -1 for s, t in zip(out.tolist(), strings, strict=True)], np.int64)

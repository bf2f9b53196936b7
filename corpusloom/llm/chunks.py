"""Per-worker memo of what a tokenizer makes of the pieces of a text.

A text is cut only where the tokenizer itself always cuts, so each piece encodes
alone as it does in place, and the library sees each distinct piece once.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable
from itertools import accumulate


class Memo:
    """``fill`` maps a list of new pieces to their values; at most ``limit`` values are held."""

    def __init__(self, fill: Callable[[list[str]], Iterable[Hashable]], limit: int = 400_000) -> None:
        self.fill, self.limit, self.known = fill, limit, {}

    def of(self, some: list[str]) -> list:
        """The values of one text's pieces; each is looked up once, and only new ones are filled."""
        known = self.known
        out = list(map(known.get, some))
        places = [i for i, v in enumerate(out) if v is None]
        if places:
            new = list({some[i] for i in places})
            if len(known) + len(new) > self.limit:
                known.clear()
            fresh = dict(zip(new, self.fill(new), strict=True))
            known.update(fresh)
            for i in places:
                out[i] = fresh[some[i]]
        return out

    def values(self, pieces: list[list[str]]) -> list[list]:
        """The values of each piece, text by text; new ones of all texts are filled together."""
        ends = list(accumulate(map(len, pieces)))
        flat = self.of([p for some in pieces for p in some])
        return [flat[end - len(some):end] for some, end in zip(pieces, ends, strict=True)]

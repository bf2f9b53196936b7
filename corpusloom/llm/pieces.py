"""SentencePiece encoding and decoding for merge-type vocabularies.

Symbols of a piece of text are merged by an agenda of adjacent pairs in order of
score, ties by place.  Pieces are first cut into parts that cannot merge.  What the
agenda makes of each distinct part, and the text its ids decode to, is held against the
library, which encodes and decodes the same parts, and the first text of every batch as
a whole; a difference raises.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import Memo
from .common import id_and_text, small_batches

#: Fixed value: the character that stands for a space.
BAR = "▁"
#: Characters up to which a piece's agenda is a plain list; less than any score.
FEW, NEVER = 40, float("-inf")


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, kinds = model.normalizer_spec, proto.ModelProto.SentencePiece
        if (model.trainer_spec.model_type != proto.TrainerSpec.BPE or spec.precompiled_charsmap or spec.remove_extra_whitespaces
                or not spec.add_dummy_prefix or not spec.escape_whitespaces or not model.trainer_spec.byte_fallback
                or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)):
            raise ValueError("only merge-type models with byte fallback and plain normalisation are known")
        self.score = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.bytes = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.raw = {i: bytes([b]) for b, i in self.bytes.items()} | {i: p.replace(BAR, " ").encode() for p, i in self.ids.items()}
        if len(model.pieces) > 1 << 16:
            raise ValueError("ids of this model take more than 16 bits")
        if any(BAR in p.lstrip(BAR) for p in self.ids):
            raise ValueError("pieces of this model hold a space after other characters")
        # no piece joins a line break or text before a space, so texts are cut there
        lines = "\n" if all("\n" not in p or p == "\n" for p in self.ids) else ""
        self.cut = re.compile(f"{BAR}*[^{BAR}{lines}]+|{BAR}+" + (f"|{lines}" if lines else ""))
        # symbols whose neighbours stand side by side in no piece never merge, so pieces are cut there
        self.meet = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.line = self.agenda("\n")
        self.head = self.agenda(BAR) + self.line
        self.parts = Memo(self._checked, limit=700_000)
        self.memo = Memo(self._whole, limit=1_000_000)

    def agenda(self, text: str) -> list[int]:
        """Ids of a piece of text by merging pairs in order of score, the leftmost of equals first."""
        out: list[int] = []
        for part in self._few(list(text)) if len(text) <= FEW else self._many(list(text)):
            known = self.ids.get(part)
            out += [known] if known is not None else [self.bytes[b] for b in part.encode()]
        return out

    def _few(self, parts: list[str]) -> list[str]:
        """The agenda as a list of scores by place: looking through a short one beats keeping it in order."""
        get = self.score.get
        worth = [get(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while worth and (best := max(worth)) > NEVER:
            i = worth.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del worth[i]
            if i < len(worth):
                worth[i] = get(parts[i] + parts[i + 1], NEVER)
            if i:
                worth[i - 1] = get(parts[i - 1] + parts[i], NEVER)
        return parts

    def _many(self, parts: list[str | None]) -> list[str]:
        """The agenda as a heap, for pieces of any length."""
        before, after = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        score, heap = self.score, []

        def offer(left: int, right: int) -> None:
            both = parts[left] + parts[right]
            if (worth := score.get(both)) is not None:
                heapq.heappush(heap, (-worth, left, right, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, left, right, both = heapq.heappop(heap)
            if parts[left] is None or parts[right] is None or after[left] != right or parts[left] + parts[right] != both:
                continue  # one of the two has been merged since
            parts[left], parts[right] = both, None
            follow = after[left] = after[right]
            if follow < len(parts):
                before[follow] = left
                offer(left, follow)
            if before[left] >= 0:
                offer(before[left], left)
        return [p for p in parts if p is not None]

    def _cut(self, piece: str) -> list[str]:
        """The parts of a piece between symbols that never merge."""
        ends = [i + 1 for i in range(len(piece) - 1) if piece[i:i + 2] not in self.meet]
        return [piece[a:b] for a, b in zip([0, *ends], [*ends, len(piece)], strict=True)]

    def _checked(self, new: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids (16 bits each) of each part and the bytes they decode to, as the library has them too.

        The library gets all of them as one text, line by line: a line break merges with
        nothing, so each line's ids are those of its part.
        """
        found = [self.agenda(p) for p in new]
        lines = [(p, ids) for p, ids in zip(new, found, strict=True) if "\n" not in p]
        text, flat = "", []
        for p, ids in lines:
            text += "\n" + p.replace(BAR, " ")
            flat += (self.line if flat else self.head) + ids
        if lines:
            self.check(text, flat, self.decode(flat))
        return [(np.array(ids, "<u2").tobytes(), b"".join(map(self.raw.__getitem__, ids))) for ids in found]

    def _whole(self, new: list[str]) -> list[tuple[bytes, bytes]]:
        """The same of whole pieces, put together from their parts."""
        return [some[0] if len(some) == 1 else tuple(map(b"".join, zip(*some, strict=True)))
                for some in self.parts.values([self._cut(p) for p in new])]

    def check(self, text: str, ids: list[int], decoded: str) -> None:
        """Raises if the library encodes or decodes a text in another way."""
        if self.library.encode(text) != ids or self.library.decode(ids) != decoded:
            raise ValueError(f"the agenda and the library differ on the text {text[:200]!r}")

    def both(self, text: str) -> tuple[bytes, bytes]:
        """Ids (16 bits each) of a text, and the bytes they decode to."""
        if not text:
            return b"", b""
        ids, raw = zip(*self.memo.of(self.cut.findall(BAR + text.replace(" ", BAR))), strict=True)
        return b"".join(ids), b"".join(raw)[1:]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.both(text)[0], "<u2").tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space that encoding puts in front goes."""
        return b"".join(map(self.raw.__getitem__, ids)).decode(errors="replace").removeprefix(" ")


@functools.lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    """The model's codec, kept with its memo for the tasks that a worker runs."""
    return Codec(path)


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` for every row of ``docs``: its ids and the text they decode to.

    ``model`` is the file's path on every machine.  Null texts are empty: no ids.
    Repeated rows and rows without id come out as they are, extra columns are not
    read, and an empty table gives no rows.  Ids and texts are built piece by
    piece, so a very long text costs no more a character than a short one.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_by = codec(model)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [found_by.both(t) for t in texts]
            if found:
                found_by.check(texts[0], np.frombuffer(found[0][0], "<u2").tolist(), found[0][1].decode(errors="replace"))
            counts = np.array([len(ids) // 2 for ids, _ in found], np.int64)
            ends = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join([ids for ids, _ in found]), "<u2").astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts), lists, pa.array([raw for _, raw in found], pa.string())],
                                             ["doc_id", "n_tokens", "ids", "decoded"])

    source = id_and_text(docs)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids array<int>, decoded string")


def digest(rows: DataFrame) -> DataFrame:
    """``ids`` (as decimal numbers with commas) and ``decoded`` replaced by their SHA-256."""
    return rows.select("doc_id", "n_tokens", F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: what ``encoded`` gives, as digests."""
    return digest(encoded(docs, model))

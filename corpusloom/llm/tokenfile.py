"""Token ids as files: frequency ranks in byte-aligned variable-length coding.

Ids are replaced by their rank in the corpus, most frequent first.  A rank takes
one to four bytes; its length less one is two bits of a control byte, and control
bytes stand apart from data bytes.  A file is a Parquet file of blocks: each block
holds whole consecutive documents, and blocks follow in ascending ``doc_id``.
The table of ranks is stored next to them.
"""

from __future__ import annotations

import functools
import json
import os
import pathlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .chunks import Memo
from .common import id_and_text, settle, small_batches

#: The id that ends a document; blocks are closed at so many tokens.
END = 1
BLOCK_TOKENS = 1 << 16
#: By control byte: bytes of its four numbers.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1
#: Characters at which Python and the tokenizer may differ on white space.
ODD = "\x1c\x1d\x1e\x1f"
#: Characters whose lower case or normal form may depend on more than themselves; without them texts are folded before they are cut.
WIDE = re.compile("[^\x00-\u024f]")
#: The pattern at which a tokenizer file cuts words, and the same for lower-case texts up to U+024F.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTER, NUMBER, BLANK = "a-zªµºß-öø-ɏ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^{BLANK}{LETTER}{NUMBER}]+")


def pack(ranks: np.ndarray, counts: np.ndarray | None = None) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of non-negative ranks under 2^32, of texts of ``counts`` numbers one after another.

    Each text's control bytes start anew.
    """
    ranks = np.ascontiguousarray(ranks, "<u4")
    counts = np.array([len(ranks)]) if counts is None else counts
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    four = np.zeros(int((-(-counts // 4)).sum()) * 4, np.uint8)
    four[_slots(counts)] = extra
    four = four.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    held = np.arange(4, dtype=np.uint8) <= extra[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[held].tobytes()


def _slots(counts: np.ndarray) -> np.ndarray:
    """Where the numbers of texts stand among their control slots, four a byte."""
    wide, ends = -(-counts // 4), np.cumsum(counts)
    return np.arange(int(counts.sum())) + np.repeat(4 * (np.cumsum(wide) - wide) - (ends - counts), counts)


def unpack(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The ranks of texts packed one after another, ``counts`` numbers each."""
    length = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[_slots(counts)]
    out = np.zeros((len(length), 4), np.uint8)
    out[np.arange(4, dtype=np.uint8) < length[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").reshape(-1)


def width(path: str) -> int:
    """Bytes that hold an id of the tokenizer and the end id."""
    spec = json.loads(pathlib.Path(path).read_text())
    top = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"]), END])
    return 2 if top < 1 << 16 else 4


class Encoder:
    """From texts to their ids (little-endian, as ``kind`` says), as the file's library gives them.

    Where the library drops white space, words encode alone as they do in place, so each
    distinct word of the texts a worker sees is encoded once.
    """

    def __init__(self, path: str, kind: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core; threads would hold memory
        from tokenizers import normalizers, pre_tokenizers

        self.kind, self.tok = kind, self._load(path)
        spec = json.loads(pathlib.Path(path).read_text())
        self.special = [t["content"] for t in spec["added_tokens"]]
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.folds = any(n.get("type") == "Lowercase" for n in (spec["normalizer"] or {}).get("normalizers", []))
        self.drops = any(s.get("behavior") == "Removed" for s in steps) and "\\s" in json.dumps(steps)
        self.words = self.any_words = Memo(lambda new: self._encode(self.tok, new), 1_000_000)
        split, bytewise = ([s for s in steps if s.get("type") == t] for t in ("Split", "ByteLevel"))
        if self.folds and len(steps) == 2 and [s["pattern"].get("Regex") for s in split] == [SPLIT] and bytewise:
            # words of narrow texts are cut here, and need no folding and no cutting any more
            plain = self._load(path)
            plain.normalizer, plain.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            pieces = Memo(lambda new: self._encode(plain, new), 600_000)
            self.words = Memo(lambda new: [b"".join(v) for v in pieces.values([PIECE.findall(w) for w in new])], 1_500_000)

    @staticmethod
    def _load(path: str):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        return tok

    def _encode(self, tok, some: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in tok.encode_batch_fast(some, add_special_tokens=False)]

    def __call__(self, text: str) -> bytes:
        narrow = self.folds and (text.isascii() or not WIDE.search(text))
        folded = text.lower() if narrow else text
        # a special string that only folding makes is none to the library
        if not self.drops or any(c in text for c in ODD) or any(s in text or s in folded for s in self.special):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        return b"".join((self.words if narrow else self.any_words).of(folded.split()))


@functools.lru_cache(maxsize=1)
def encoder(path: str, kind: str = "<u4") -> Encoder:
    """The file's encoder, kept with its memo for the tasks that a worker runs."""
    return Encoder(path, kind)


def write(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Encodes ``docs`` and writes ``path/blocks`` and ``path/ranks``.

    Three passes: encode (ids are settled in the shared folder, narrow), count, and
    sort into ascending ``doc_id``, where ranks are packed into blocks.  Only the table
    of ranks, bounded by the vocabulary, goes to all tasks.  Null texts are empty and
    hold the end id alone; rows without id come first; rows that share an id are all
    written, next to each other, in the order of their ids' bytes; extra columns are not
    read; an empty table gives files without blocks.
    """
    spark = docs.sparkSession
    small_batches(spark)
    source = id_and_text(docs)
    kind, wide = source.schema["doc_id"].dataType.simpleString(), width(tokenizer)
    end = END.to_bytes(wide, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer, f"<u{wide}")
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([ids_of(t) + end for t in batch.column(1).to_pylist()], pa.binary())], ["doc_id", "ids"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            seen = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), f"<u{wide}"), minlength=len(total))
            total = np.pad(total, (0, len(seen) - len(total))) + seen
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["id", "n"])

    encoded = settle(source.mapInArrow(encode, f"doc_id {kind}, ids binary"), "ids")
    counts = encoded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ranks = counts.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1)
    ranks.coalesce(1).write.parquet(f"{path}/ranks")
    order = ranks_of(spark, path)
    place = np.zeros(int(order.max(initial=0)) + 1, np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs_of, raws, held, number, before = [], [], 0, 0, 0

        def close(part: int) -> pa.RecordBatch:
            nonlocal held, number, before
            counts = np.array([len(raw) // wide for raw in raws], "<i8")
            control, data = pack(place[np.frombuffer(b"".join(raws), f"<u{wide}")], counts)
            row = {"part": part, "block": number, "before": before, "n_tokens": held, "doc_ids": list(docs_of),
                   "counts": counts.tobytes(), "control": control, "data": data}
            number, before, held = number + 1, before + held, 0
            docs_of.clear()
            raws.clear()
            return pa.RecordBatch.from_pylist([row], schema)

        part = -1
        for batch in batches:
            for doc_id, raw, part in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                docs_of.append(doc_id)
                raws.append(raw)
                held += len(raw) // wide
                if held >= BLOCK_TOKENS:
                    yield close(part)
        if raws:
            yield close(part)

    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()),
                        ("doc_ids", pa.list_(to_arrow_type(source.schema["doc_id"].dataType))),
                        ("counts", pa.binary()), ("control", pa.binary()), ("data", pa.binary())])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (encoded.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "ids")
     .withColumn("part", F.spark_partition_id())
     .mapInArrow(block, f"part int, block int, before long, n_tokens long, doc_ids array<{kind}>, counts binary, control binary, data binary")
     .write.option("compression", "zstd").parquet(f"{path}/blocks"))


def ranks_of(spark: SparkSession, path: str) -> np.ndarray:
    """Ids by rank: at most as many as the vocabulary has."""
    return np.array([r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").select("id").collect()], np.int64)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` from the files; ``ids`` are little-endian, 32 bits each.

    ``start`` counts the tokens of all documents before: a sum over parts, of which
    there are as many as shuffle partitions, plus what its part holds before it.
    """
    order = ranks_of(spark, path).astype("<u4")
    blocks = spark.read.parquet(f"{path}/blocks")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], "<i8")
                ends = np.cumsum(counts)
                ids = order[unpack(row["control"], row["data"], counts)]
                start = row["base"] + row["before"] + ends - counts
                offsets = np.concatenate(([0], 4 * ends)).astype("<i4")
                texts = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type), pa.array(start, pa.int64()),
                     pa.array(counts, pa.int64()), texts], ["doc_id", "start", "n_tokens", "ids"])

    return (blocks.join(F.broadcast(parts), "part").select("doc_ids", "counts", "control", "data", "before", "base")
            .mapInArrow(decode, f"doc_id {kind}, start long, n_tokens long, ids binary"))


def digest(rows: DataFrame) -> DataFrame:
    """``ids`` replaced by ``ids_crc32``, unsigned."""
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

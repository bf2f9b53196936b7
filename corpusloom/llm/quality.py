"""Quality classifier: random-indexing word vectors, pooled, into a two-layer network.

Each hashed word has a sparse random index vector; its word vector is the sum of the
index vectors of its neighbours over the whole corpus.  A document is the mean and
the spread of its words' vectors and its length.  A two-layer numpy network
learns the labels from them, and a temperature set on rows kept from the training
calibrates its probabilities.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, small_batches

#: Hash buckets of words, dimensions of a vector, neighbours on either side.
BUCKETS, DIMS, REACH = 1 << 14, 32, 2
#: Labelled rows that the network is fitted on, at most; every eighth of them calibrates it.
FITTED = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 24, 60, 256, 0.01, 1e-4
THRESHOLD = 0.7
#: Text bytes turned into words together; longer texts are read in parts.
PART = 1 << 18
SEED = 20_11

_BASE = np.uint64(0x100000001B3)
_INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))


def _powers(base: np.uint64) -> np.ndarray:
    out = np.full(PART + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER, _BACK = _powers(_BASE), _powers(_INVERSE)
#: White space, letters and digits (every byte above ASCII counts as a letter), marks.
_CLASS = np.full(256, 2, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def words(text: bytes) -> np.ndarray:
    """The bucket of each word and each run of marks, in order."""
    out = []
    while text:
        part = text[:PART]
        if len(text) > PART:  # cut at the last white space, if there is any
            cut = max(part.rfind(b" "), part.rfind(b"\n"))
            part = part[:cut] if cut > 0 else part
        data = np.frombuffer(part, np.uint8)
        kind = _CLASS[data]
        cuts = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        begin, end = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(data)]))
        some = kind[begin] > 0
        begin, end = begin[some], end[some]
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(data * _POWER[:len(data)], dtype=np.uint64)))
        value = (total[end] - total[begin]) * _BACK[begin] * np.uint64(0x9E3779B97F4A7C15)
        out.append((value >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64))
        text = text[len(part):]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Of each bucket, the two places of its index vector that are not zero, and their signs."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, DIMS, (BUCKETS, 2)), rng.choice(np.array([-1, 1], np.int32), (BUCKETS, 2))


def context_sums(docs: DataFrame) -> DataFrame:
    """``bucket, n, c0 ...``: how often each bucket occurs, and the sum of its neighbours' index vectors."""
    names = [f"c{i}" for i in range(DIMS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors()
        sums, seen = np.zeros(BUCKETS * DIMS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                b = words(text.encode())
                np.add.at(seen, b, 1)
                for step in range(1, REACH + 1):
                    for a, c in ((b[:-step], b[step:]), (b[step:], b[:-step])):
                        for k in range(2):
                            np.add.at(sums, a * DIMS + place[c, k], sign[c, k])
        rows = np.flatnonzero(seen)
        table = sums.reshape(BUCKETS, DIMS)[rows]
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(seen[rows]), *(pa.array(table[:, i]) for i in range(DIMS))], ["bucket", "n", *names])

    parts = docs.select("text").mapInArrow(run, "bucket long, n long, " + ", ".join(f"{c} long" for c in names))
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in names))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Vectors of unit length, one row a bucket; rows of buckets that do not occur are zero.

    The table's size is a parameter, so it fits the driver whatever the corpus.
    """
    out = np.zeros((BUCKETS, DIMS), np.float32)
    for row in context_sums(docs).toLocalIterator():
        out[row["bucket"]] = row[2:]
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, length, out=out, where=length > 0)


def pool(text: str, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the words' vectors, and the logarithm of their number; zeros where there are none."""
    b = words(text.encode())
    if not len(b):
        return np.zeros(2 * DIMS + 1, np.float32)
    total, squares = np.zeros(DIMS), np.zeros(DIMS)
    for start in range(0, len(b), 1 << 14):
        some = vectors[b[start:start + (1 << 14)]]
        total += some.sum(0)
        squares += np.einsum("ij,ij->j", some, some)
    mean = total / len(b)
    return np.concatenate((mean, np.sqrt(np.maximum(squares / len(b) - mean ** 2, 0)), [np.log1p(len(b)) / 5])).astype(np.float32)


@dataclass
class Network:
    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Trains on seven eighths of the rows and sets the temperature on the rest; the same rows give the same network."""
    rng = np.random.default_rng(SEED)
    share = (y.sum() + 1) / (len(y) + 2)
    if len(y) < 16 or y.min() == y.max():  # nothing to tell apart: the share itself
        wide = x.shape[1]
        return Network(np.zeros(wide), np.ones(wide), np.zeros((wide, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    held = np.arange(len(y)) % 8 == 7
    xt, yt, xc, yc = x[~held], y[~held], x[held], y[held]
    net = Network(xt.mean(0), xt.std(0) + 1e-3, rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), float(np.log(share / (1 - share))))
    z = (xt - net.shift) / net.scale
    values = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second, t = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(yt))
        for start in range(0, len(order), BATCH):
            some = order[start:start + BATCH]
            hidden = np.tanh(z[some] @ values[0] + values[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ values[2] + values[3], -30, 30))) - yt[some]) / len(some)
            back = np.outer(error, values[2]) * (1 - hidden ** 2)
            slopes = [z[some].T @ back + DECAY * values[0], back.sum(0), hidden.T @ error + DECAY * values[2], np.array([error.sum()])]
            t += 1
            for v, g, m, s in zip(values, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-8)
    net.b2 = float(values[3][0])
    logits = net.logits(xc)

    def loss(temperature: float) -> float:
        return float(np.mean(np.logaddexp(0, np.where(yc == 1, -1, 1) * logits / temperature)))

    net.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return net


def held_out(doc_id) -> F.Column:
    """Whether labels of this row are not learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def classify(docs: DataFrame, labels: DataFrame, limit: int = FITTED) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    The network is fitted on at most ``limit`` labelled rows that are not held out,
    drawn by hash; word vectors are counted over all documents.  Only the text makes
    a score.  Null and empty texts score as texts without words; rows without id count
    as not held out; an id labelled more than once takes its largest label; rows that
    repeat get equal scores.  Extra columns are not read, an empty table gives no
    rows, and without labels every score is the same.
    """
    spark = docs.sparkSession
    small_batches(spark)
    source = id_and_text(docs)
    kind = source.schema["doc_id"].dataType.simpleString()
    vectors = spark.sparkContext.broadcast(word_vectors(source))
    known = (labels.select(labels["doc_id"].alias("doc_id"), labels["quality"].alias("y")).filter("doc_id IS NOT NULL AND y IS NOT NULL")
             .filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").cast("int").alias("y")))
    drawn = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))  # at most ``limit`` rows

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [pool(t, vectors.value).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary()), batch.column(2)], ["doc_id", "x", "y"])

    rows = source.join(drawn, "doc_id").select("doc_id", "text", "y").mapInArrow(pooled, f"doc_id {kind}, x binary, y int").dropDuplicates(["doc_id"])
    sample = sorted((zlib.crc32(str(r["doc_id"]).encode()[::-1]), str(r["doc_id"]), bytes(r["x"]), r["y"]) for r in rows.toLocalIterator())
    x = np.array([np.frombuffer(r[2], np.float32) for r in sample], np.float64).reshape(-1, 2 * DIMS + 1)
    net = fit(x, np.array([r[3] for r in sample], np.float64))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [pool(t, vectors.value) for t in batch.column(1).to_pylist()]
            score = net.score(np.array(x, np.float64).reshape(-1, 2 * DIMS + 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    return (source.mapInArrow(scored, f"doc_id {kind}, score double")
            .select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))

"""Token counts through a digest cache.

The cache is a Parquet table of ``digest, tokenizer, n_tokens``.  A text is known
by the SHA-256 of its content and by the SHA-256 of the tokenizer's file; only
distinct texts without an entry are encoded, and their counts are appended.
"""

from __future__ import annotations

import hashlib
import json
import os
import pathlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunks import Memo
from .common import id_and_text, small_batches

LIMIT = 1024
CACHE = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("tokenizer", T.StringType()),
                      T.StructField("n_tokens", T.LongType())])
#: The white space of the tokenizer's pattern.
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The pattern cuts at white space in these three ways before it looks at letters.
CUT = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")


def counter(path: str):
    """A function from texts to token counts, as the file's library gives them."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core; threads would hold memory
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()

    def whole(texts: list[str]) -> list[int]:
        return [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]

    spec = json.loads(pathlib.Path(path).read_text())
    plain = (spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel"
             and spec["pre_tokenizer"]["use_regex"] and not spec["pre_tokenizer"]["add_prefix_space"])
    if not plain:
        return whole
    special = [t["content"] for t in spec["added_tokens"]]
    memo = Memo(lambda new: [len(e.ids) for e in tok.encode_batch_fast(new, add_special_tokens=False)], 250_000)

    def cut(texts: list[str]) -> list[int]:
        out = []
        for text in texts:
            if any(s in text for s in special):
                out += whole([text])
            else:
                out.append(sum(memo.values([CUT.findall(text)])[0]))
        return out

    return cut


def version(path: str) -> str:
    """Names the tokenizer by its content."""
    return hashlib.sha256(pathlib.Path(path).read_bytes()).hexdigest()


def open_cache(spark: SparkSession, cache: str) -> DataFrame:
    spark.createDataFrame([], CACHE).write.mode("ignore").parquet(cache)
    return spark.read.schema(CACHE).parquet(cache)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    ``tokenizer`` is the file's path on every machine; ``cache`` a folder all of
    them reach, which grows by the new texts.  Null texts are empty and count 0.
    Repeated rows and texts share one entry, and rows without id come out as they
    are.  Extra columns are not read; an empty table gives no rows.  A run that
    dies before its append leaves the cache as it was; two runs that append the
    same text leave two equal entries, of which one is read.
    """
    spark, name = docs.sparkSession, version(tokenizer)
    small_batches(spark)
    keyed = id_and_text(docs).withColumn("digest", F.unhex(F.sha2("text", 256)))
    stored = open_cache(spark, cache).filter(F.col("tokenizer") == name)
    misses = keyed.groupBy("digest").agg(F.first("text").alias("text")).join(stored, "digest", "left_anti").select("digest", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for batch in batches:
            n = count(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([name] * len(n)), pa.array(n, pa.int64())], CACHE.names)

    misses.mapInArrow(run, CACHE).write.mode("append").parquet(cache)
    counts = (spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == name)
              .groupBy("digest").agg(F.first("n_tokens").alias("n_tokens")))
    return (keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")).join(counts, "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))

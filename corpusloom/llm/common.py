"""Helpers the operators share: tables, text columns, tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words.
SPACE = r"\x20\x09-\x0D"

#: Rows and bytes that go to a Python worker at once; a batch ends at the first of the two it reaches.
BATCH_ROWS, BATCH_BYTES = 500, 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with null texts as empty ones; other columns are left behind."""
    return docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))


def words(text: Column) -> Column:
    """The words of a text, in order; an empty array where it has none."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def sealed(df: DataFrame, *exprs: str) -> DataFrame:
    """``df.selectExpr(*exprs)``, closed to filters from above.

    The optimizer would push a filter on the result through the projections below by
    writing their expressions out again, also inside functions of array elements,
    where they would run once an element.  It doesn't push through a generator.
    """
    return df.select(F.inline(F.array(F.struct(*map(F.expr, exprs)))))


def small_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker holds at once, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="corpusloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; it goes when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def settle(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it again, which cuts its lineage."""
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

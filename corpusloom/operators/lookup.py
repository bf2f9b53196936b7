"""Words of documents replaced by what a table says of them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PART, _PLACE, _WORD, _FORM = "_lookup_part", "_lookup_place", "_lookup_word", "_lookup_form"


def replaced(df: DataFrame, tokens: str, table: Callable[[DataFrame], DataFrame], kind: T.DataType | None = None, missing: int | str | None = None, key: str = "doc_id") -> DataFrame:
    """``df`` with each word of the array ``tokens`` replaced, in order.

    ``table`` gets the different words (column ``word``) and gives ``word, form``; a word it
    leaves out becomes ``missing``.  ``kind`` is the type of the forms (by default that of the words).

    Rows are dealt into parts, by ``key`` as :func:`..session.spread` does or without such a
    column by what they hold, and a part gets each of its words once, with its form: rows
    travel once, as they are, and no row a word does.  ``df`` is read twice.
    """
    kind = kind or df.schema[tokens].dataType.elementType
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [key] if key in df.columns else [*(f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)), tokens]
    rows = df.withColumn(_PART, F.pmod(F.hash(*by), F.lit(parts)))
    pairs = rows.select(F.col(_PART).alias(_PLACE), F.explode(tokens).alias("word")).filter("word IS NOT NULL").distinct()
    # a number of partitions of its own: the work on a word may be far more than its bytes tell
    forms = table(pairs.select("word").distinct().repartition(parts, "word")).select(F.col("word").alias(_WORD), F.col("form").alias(_FORM))
    known = pairs.join(forms, F.col("word") == F.col(_WORD)).select(_PLACE, _WORD, _FORM)
    schema = T.StructType([T.StructField(f.name, T.ArrayType(kind) if f.name == tokens else f.dataType) for f in df.schema])
    return rows.groupBy(_PART).cogroup(known.groupBy(_PLACE)).applyInArrow(_replacing(tokens, missing), schema)


def _replacing(tokens: str, missing: int | str | None):
    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        rows = rows.drop_columns([_PART])
        lists = rows.column(tokens).combine_chunks()
        words = lists.flatten()
        forms = known.column(_FORM).combine_chunks().take(pc.index_in(words, value_set=known.column(_WORD).combine_chunks()))
        if missing is not None:
            forms = pc.fill_null(forms, pa.scalar(missing, forms.type))
        lengths = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
        ends = pa.array(np.append(0, np.cumsum(lengths)), pa.int32())
        made = pa.ListArray.from_arrays(ends, forms)
        if lists.null_count:
            made = pa.ListArray.from_arrays(ends, forms, mask=pa.array(lists.is_null().to_numpy(zero_copy_only=False)))
        return rows.set_column(rows.column_names.index(tokens), tokens, made)

    return run

"""Registered queries, each with the SQL that checks it where SQL can.

A query is a function ``(spark, data_dir) -> DataFrame``.  The SQL is written
for DuckDB, independently of the DataFrame code.
"""

from __future__ import annotations

from .base import ORACLES, QUERIES
from . import (  # noqa: F401  (importing registers the queries)
    basics, embeddings, features, language, learning, registry, text)

__all__ = ["ORACLES", "QUERIES"]

"""A catalog entry: one query on the test tables, and the same question in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Entry:
    """``run(spark, sf_dir)`` gives the result; ``sql`` states it for an independent engine."""

    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None

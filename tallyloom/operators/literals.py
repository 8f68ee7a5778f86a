"""Short tables known when a plan is built."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_rows(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence[object]]) -> DataFrame:
    """A few rows as an expression, without a Python worker."""
    entries = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*entries)))

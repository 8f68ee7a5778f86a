"""Ordered extracts, where a caller asks for one, samples, and counts for a scatter chart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Groups in which the tasks' rows of a sample meet first.
MERGE = 64
#: Width of a cell of the scatter chart, in money.
SCATTER_CELL = 100
#: Points of the scatter chart, as many as the report shows.
SCATTER_POINTS = 500


def top_rows(df: DataFrame, order: Sequence[Column | str], n: int | None) -> DataFrame:
    """The first ``n`` rows in the order given; all rows, as they lie, without an ``n``."""
    return df if n is None else df.orderBy(*order).limit(n)


def scatter_cells(rows: DataFrame, width: int = SCATTER_CELL) -> DataFrame:
    """Error rows by cell of (balance gap, day gap): a chart's points with their weight.

    ``x`` is the lower edge of the cell, ``y`` the day gap. Every row is counted.
    """
    edge = F.floor(F.col("bal_diff") / width) * width
    return rows.groupBy(edge.cast("double").alias("x"), F.col("date_diff_days").alias("y")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def hash_sample(rows: DataFrame, n: int, by: Sequence[Column | str] | None = None) -> DataFrame:
    """The ``n`` rows with the smallest digest of ``by`` (all cells); all rows if there are no more.

    The digest depends on a row's content alone, so the sample is the same however the rows lie
    and whichever task is run again. Every task keeps ``n`` rows at most; these meet in ``MERGE``
    groups, of which each keeps ``n``, and last in one. Of rows that agree in ``by`` any may stand
    for the others; a null cell differs from an empty one.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in by or rows.columns]
    cells = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("")) for c in columns]
    marked = rows.withColumns({"_digest": F.md5(F.concat_ws("|", *cells).cast("binary")), "_group": F.spark_partition_id() % MERGE})
    place = F.row_number().over(Window.partitionBy("_group").orderBy("_digest"))
    few = marked.withColumn("_place", place).where(F.col("_place") <= n)
    return few.orderBy("_digest").limit(n).select(*rows.columns)


def scatter_sample(rows: DataFrame, n: int = SCATTER_POINTS) -> DataFrame:
    """Points of a scatter chart, error by error: balance gap, day gap, account."""
    cents = [F.round(F.col(c) * 100).cast("bigint") for c in ("bal_a", "bal_b")]
    chosen = hash_sample(rows, n, ["acc_no", "date_a", "date_b", *cents])
    return chosen.select(F.col("bal_diff").alias("x"), F.col("date_diff_days").alias("y"), "acc_no")

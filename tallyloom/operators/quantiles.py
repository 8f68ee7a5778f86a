"""Exact, interpolated quantiles without one task holding all values.

Equal values collapse first; cut points from a bounded sketch split the distinct
values into bins; only the bins that hold a wanted rank are sorted.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 512


def value_counts(df: DataFrame, value: Column, weight: Column | None = None) -> DataFrame:
    """Distinct values ``v`` with their number of rows ``n``; nulls left out."""
    rows = df.select(value.alias("v"), (weight if weight is not None else F.lit(1)).cast("bigint").alias("w"))
    counts = rows.where(F.col("v").isNotNull()).groupBy("v").agg(F.sum("w").alias("n"))
    # The condition keeps `n` in every later use, so all uses share one shuffle.
    return counts.where(F.col("n") > 0)


def quantiles(counts: DataFrame, wanted: Mapping[str, float], bins: int = BINS) -> DataFrame:
    """One row with a column per wanted quantile, linearly interpolated.

    ``counts`` comes from ``value_counts``. An empty input gives nulls.
    """
    cuts = counts.agg(
        F.percentile_approx("v", [i / bins for i in range(1, bins)], 20 * bins).alias("cuts")
    ).scalar()
    below = F.filter("cuts", lambda c: c < F.col("v"))
    binned = counts.withColumn("cuts", F.array_distinct(cuts)).select(
        "v", "n", F.coalesce(F.size(below), F.lit(0)).alias("bin")
    )

    # At most `bins` rows, so windows over all of them stay small.
    running = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = (
        binned.groupBy("bin")
        .agg(F.sum("n").alias("bin_n"))
        .withColumn("upto", F.sum("bin_n").over(running))
        .withColumn("total", F.sum("bin_n").over(Window.partitionBy()))
        .withColumn("before", F.col("upto") - F.col("bin_n"))
    )
    marks = []
    for name, p in wanted.items():
        place = F.lit(float(p)) * (F.col("total") - 1)
        for side, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            marks.append(
                F.struct(
                    F.lit(name).alias("name"),
                    F.lit(side).alias("side"),
                    rank.cast("bigint").alias("rank"),
                    (place - F.floor(place)).alias("part"),
                )
            )
    here = F.filter(F.array(*marks), lambda m: (m.rank >= F.col("before")) & (m.rank < F.col("upto")))
    wanted_bins = ends.select("bin", "before", here.alias("marks")).where(F.size("marks") > 0)

    # Only the wanted bins are ordered, each about 1/bins of the distinct values.
    inside = Window.partitionBy("bin").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    picked = (
        binned.join(F.broadcast(wanted_bins), "bin")  # at most two rows per wanted quantile
        .withColumn("last", F.col("before") + F.sum("n").over(inside))
        .select(
            "v",
            F.explode(
                F.filter(
                    "marks",
                    lambda m: (m.rank < F.col("last")) & (m.rank >= F.col("last") - F.col("n")),
                )
            ).alias("m"),
        )
    )
    columns = []
    for name in wanted:
        mine = F.col("m.name") == name
        low = F.max(F.when(mine & (F.col("m.side") == "low"), F.col("v")))
        high = F.max(F.when(mine & (F.col("m.side") == "high"), F.col("v")))
        part = F.max(F.when(mine, F.col("m.part")))
        columns.append((low + (high - low) * part).alias(name))
    return picked.agg(*columns)

"""Equi-joins that stay balanced when a few keys hold a large part of the rows.

Heavy keys are found with a frequent-items sketch (one column-pruned pass, no
shuffle, bounded result). Rows of those keys are first collapsed to distinct rows
with a copy count, then spread over a salt grid; all other rows take the plain join.
Which keys count as heavy never changes the result, only where the work runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES = "copies"
NULL_MARK = "\u0000"
CHUNK = 100_000


@dataclass(frozen=True)
class SkewGuard:
    """When a key is heavy, and how far its rows are spread.

    A key is heavy from ``min_rows`` rows, what one task should hold, however many rows
    there are. ``max_keys`` bounds what reaches the driver and the plan; ``tracked`` bounds
    the sketch, which reports every key with more than about ``1/tracked`` of the rows.
    """

    min_rows: int = 1_000_000
    max_keys: int = 1024
    tracked: int = 16_384
    salts: int = 16


DEFAULT_GUARD = SkewGuard()


def heavy_keys(frames: Sequence[DataFrame], key: str, guard: SkewGuard = DEFAULT_GUARD) -> list[list]:
    """Per frame, at most ``guard.max_keys`` keys that hold more rows than a task should.

    One job over the key columns alone. Pass frames as early in their lineage as the
    key exists: which keys are reported steers the work, not the result.
    """
    tagged = reduce(
        lambda a, b: a.unionByName(b),
        [f.select(F.col(key).alias("k"), F.lit(i).alias("side")) for i, f in enumerate(frames)],
    ).where("k is not null")
    row = tagged.agg(
        *[
            F.expr(f"{call} filter (where side = {i})").alias(f"{name}{i}")
            for i in range(len(frames))
            for name, call in (("top", f"approx_top_k(k, {guard.max_keys}, {guard.tracked})"),)
        ]
    ).first()
    heavy = []
    for i in range(len(frames)):
        heavy.append([e["item"] for e in (row[f"top{i}"] or []) if e["count"] >= guard.min_rows])
    return heavy


def _collapse(df: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))


def _slot(df: DataFrame, salts: int) -> Column:
    """A salt taken from the row itself, so a re-run task gives the same one."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int")


def spread_nulls(key: str, salts: int = 1024) -> Column:
    """The key, with null replaced by texts no key can equal: an outer join must not
    send every null row to one task."""
    # Taken from the task, not the row: copies of one row spread too, and a re-run task
    # gives the same text.
    spare = F.concat(F.lit(NULL_MARK), F.pmod(F.spark_partition_id(), F.lit(salts)).cast("string"))
    # The last fallback is never used; it tells the planner the result is not null.
    return F.coalesce(F.col(key), F.when(F.col(key).isNull(), spare), F.lit(NULL_MARK))


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    guard: SkewGuard | None = DEFAULT_GUARD,
    known_heavy: Sequence[list] | None = None,
) -> DataFrame:
    """Join on one key column; ``copies`` tells how many joined rows a row stands for.

    ``how`` is ``inner`` or ``left``. Other column names must not overlap.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    right = right.where(F.col(key).isNotNull())
    if how == "inner":
        left = left.where(F.col(key).isNotNull())

    if known_heavy is None:
        known_heavy = heavy_keys([left, right], key, guard) if guard else ([], [])
    heavy_left, heavy_right = known_heavy
    heavy = sorted(set(heavy_left) | set(heavy_right))

    if not heavy:
        return _plain(left, right, key, how).withColumn(COPIES, F.lit(1).cast("bigint"))

    salts = guard.salts if guard else DEFAULT_GUARD.salts
    is_heavy = F.coalesce(F.col(key).isin(heavy), F.lit(False))
    rest = _plain(left.where(~is_heavy), right.where(~is_heavy), key, how)
    hot = _grid(left.where(is_heavy), right.where(is_heavy), key, how, heavy_left, heavy_right, salts)
    return rest.withColumn(COPIES, F.lit(1).cast("bigint")).unionByName(hot)


def _plain(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    if how == "inner":
        return left.join(right, key, "inner")
    joined = left.withColumn(key, spread_nulls(key)).join(right, key, "left")
    real = F.when(~F.startswith(F.col(key), F.lit(NULL_MARK)), F.col(key))
    return joined.withColumn(key, real)


def _grid(left, right, key, how, heavy_left, heavy_right, salts):
    """Both sides collapsed, each salted along its own axis and copied along the other."""
    left_names = left.columns
    right_names = [c for c in right.columns if c != key]
    rows_split = F.col(key).isin(heavy_left) if heavy_left else F.lit(False)
    cols_split = F.col(key).isin(heavy_right) if heavy_right else F.lit(False)
    zero, axis = F.lit(0), F.sequence(F.lit(0), F.lit(salts - 1))

    lhs = (
        _collapse(left)
        .withColumn("_row", F.when(rows_split, _slot(left, salts)).otherwise(zero))
        .withColumn("_col", F.explode(F.when(cols_split, axis).otherwise(F.array(zero))))
        .withColumnRenamed("_n", "_nl")
    )
    rhs = (
        _collapse(right)
        .withColumn("_col", F.when(cols_split, _slot(right, salts)).otherwise(zero))
        .withColumn("_row", F.explode(F.when(rows_split, axis).otherwise(F.array(zero))))
        .withColumnRenamed("_n", "_nr")
    )
    joined = lhs.join(rhs, [key, "_row", "_col"], how)
    if how == "left" and heavy_right:
        # A key heavy on the right has a partner in some cell; cells without one are
        # an effect of the grid, not unmatched rows.
        joined = joined.where(F.col("_nr").isNotNull() | ~cols_split)
    copies = F.col("_nl") * F.coalesce(F.col("_nr"), F.lit(1))
    return joined.select(*left_names, *right_names, copies.alias(COPIES))


def balanced_join_all(
    frames: Sequence[DataFrame],
    key: str,
    guard: SkewGuard | None = DEFAULT_GUARD,
    known_heavy: Sequence[list] | None = None,
) -> DataFrame:
    """Inner join of several frames on one key, left to right."""
    frames = [f.where(F.col(key).isNotNull()) for f in frames]
    if known_heavy is None:
        known_heavy = heavy_keys(frames, key, guard) if guard else [[] for _ in frames]
    every = sorted(set().union(*known_heavy))
    if not every:
        return reduce(lambda a, b: a.join(b, key, "inner"), frames).withColumn(COPIES, F.lit(1).cast("bigint"))

    salts = (guard or DEFAULT_GUARD).salts
    is_heavy = F.col(key).isin(every)
    rest = reduce(lambda a, b: a.join(b, key, "inner"), [f.where(~is_heavy) for f in frames])
    hot = _collapse(frames[0].where(is_heavy)).withColumnRenamed("_n", COPIES)
    for frame in frames[1:]:
        # After the first join any heavy key may be long on the left side too.
        hot = _grid_weighted(hot, frame.where(is_heavy), key, every, every, salts)
    return rest.withColumn(COPIES, F.lit(1).cast("bigint")).unionByName(hot)


def _grid_weighted(left, right, key, heavy_left, heavy_right, salts):
    """Grid join of an already collapsed left side that carries ``copies``."""
    weight = "_w"
    joined = _grid(left.withColumnRenamed(COPIES, weight), right, key, "inner", heavy_left, heavy_right, salts)
    return joined.withColumn(COPIES, F.col(COPIES) * F.col(weight)).drop(weight)


def expand_copies(df: DataFrame) -> DataFrame:
    """One row per joined row again: the row-level listing of a weighted join."""
    # Two steps, so that no single array grows with the number of copies.
    last = F.floor((F.col(COPIES) - 1) / CHUNK)
    chunks = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    size = F.least(F.lit(CHUNK), F.col(COPIES) - F.col("_chunk") * CHUNK).cast("int")
    return chunks.withColumn("_one", F.explode(F.array_repeat(F.lit(1), size))).drop("_chunk", "_one", COPIES)

"""Class counts of heavy accounts without forming their row pairs.

A key with very many rows on both sides stands for very many joined rows, but the
counters only need how many of them agree. Both sides are grouped first (map-side), so
every join below is between grouped rows; balances within the tolerance meet in cells
a few tolerances wide, never across a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import comparing as cmp
from tallyloom.functions.parsing import YEAR_RANGE
from tallyloom.operators.matching import KEY


#: Products of group sizes pass a bigint from some two million rows in each of three ledgers.
WIDE = "decimal(38,0)"


def _grouped(df: DataFrame, names: Sequence[str], n: str) -> DataFrame:
    return df.groupBy(*names).agg(F.count(F.lit(1)).cast(WIDE).alias(n))


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast(WIDE)


def _rows_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False))).cast(WIDE)


def _near(base: DataFrame, other: DataFrame, on: Sequence[str], tolerance: float, n: str) -> DataFrame:
    """Rows of ``other`` within the tolerance of each distinct ``v`` of ``base``.

    ``other`` has ``on``, ``w`` and a row count ``n``; the result has ``on``, ``v``, ``n``.
    """
    # Decimal balances get decimal cells, whose edges are exact.
    width = F.lit(max(5 * tolerance, type(tolerance)("0.01")))
    cells = F.array(*[F.floor(F.col("v") / width) + step for step in (-1, 0, 1)])
    left = base.select(*on, "v").distinct().withColumn("_cell", F.explode(cells))
    right = other.withColumn("_cell", F.floor(F.col("w") / width))
    hits = left.join(right, [*on, "_cell"]).where(cmp.within(F.col("v"), F.col("w"), tolerance))
    return hits.groupBy(*on, "v").agg(F.sum(n).cast(WIDE).alias(n))


def _agreeing(base: DataFrame, others: Sequence[DataFrame], on: Sequence[str], tolerance: float) -> DataFrame:
    """Joined rows whose balances agree along ``on``: one row, ``pairs``.

    ``base`` has the balance ``v``, every other frame the balance ``w``.
    """
    counted = _grouped(base, [*on, "v"], "n")
    weight = F.col("n")
    for i, other in enumerate(others):
        counted = counted.join(_near(base, _grouped(other, [*on, "w"], f"n{i}"), on, tolerance, f"n{i}"), [*on, "v"])
        weight = weight * F.col(f"n{i}")
    return counted.agg(_total(weight).alias("pairs"))


def _same(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Joined rows that share ``on``: one row, ``pairs``."""
    counted, weight = _grouped(frames[0], on, "n0"), F.col("n0")
    for i, frame in enumerate(frames[1:], 1):
        counted = counted.join(_grouped(frame, on, f"n{i}"), list(on))
        weight = weight * F.col(f"n{i}")
    return counted.agg(_total(weight).alias("pairs"))


def _classes(matched: Column, dates: Column, balances: Column, perfect: Column) -> list[Column]:
    return [
        matched.alias("matched_rows"),
        perfect.alias(cmp.PERFECT),
        (balances - perfect).alias(cmp.DATE_ONLY),
        (dates - perfect).alias(cmp.BALANCE_ONLY),
        (matched - dates - balances + perfect).alias(cmp.BOTH),
    ]


def _side(df: DataFrame, day: str, year_range: tuple[int, int] | None, **balance: str) -> DataFrame:
    usable = cmp.dates_usable(F.col(day), year_range=year_range)
    return df.select(
        KEY, F.when(usable, F.col(day)).alias("day"), *[F.col(c).alias(n) for n, c in balance.items()]
    )


def _dated(df: DataFrame) -> DataFrame:
    return df.where(F.col("day").isNotNull())


def _pair_parts(base, other, tolerance):
    return {
        "dates": _same([_dated(base), _dated(other)], [KEY, "day"]),
        "balances": _agreeing(base, [other], [KEY], tolerance),
        "perfect": _agreeing(_dated(base), [_dated(other)], [KEY, "day"], tolerance),
    }


def _one(row: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    return row.select("*", *[df.scalar().alias(f"_{name}") for name, df in parts.items()])


def heavy_ab_counts(
    system: DataFrame, counterpart: DataFrame, tolerance: float, year_range: tuple[int, int] | None = None
) -> DataFrame:
    """The counters of the A-B summary for the rows given (cleaned ledgers)."""
    base = _side(counterpart, "day_b", year_range, v="bal_b")
    parts = _pair_parts(base, _side(system, "day_a", year_range, w="bal_a"), tolerance)
    parts["exact"] = _agreeing(base, [_side(system, "day_a", year_range, w="exact_bal")], [KEY], tolerance)
    of_b = counterpart.groupBy(KEY).agg(
        F.count(F.lit(1)).cast(WIDE).alias("nb"), _rows_if(~F.col("bad_balance_b")).alias("good_b")
    )
    of_a = system.groupBy(KEY).agg(
        F.count(F.lit(1)).cast(WIDE).alias("na"),
        _rows_if(~F.col("bad_balance_a")).alias("good_a"),
        _rows_if(~cmp.within(F.col("bal_a"), F.col("exact_bal"), tolerance)).alias("apart"),
        _rows_if(F.col("bal_a") < F.col("exact_bal")).alias("below"),
    )
    nb, na = F.col("nb"), F.col("na")
    row = of_b.join(of_a, KEY, "left").agg(
        _total(nb * na).alias("_matched"),
        _total(F.when(na.isNull(), nb)).alias("unmatched_b"),
        _total(nb * F.col("apart")).alias("exact_vs_pre_mismatches"),
        _total(nb * F.col("below")).alias("debt_separation_cases"),
        _total(nb * na - F.col("good_a") * F.col("good_b")).alias("bad_balances"),
    )
    matched = F.col("_matched")
    return _one(row, parts).select(
        *_classes(matched, F.col("_dates"), F.col("_balances"), F.col("_perfect")),
        "unmatched_b",
        (matched - F.col("_exact")).alias("exact_vs_b_mismatches"),
        "exact_vs_pre_mismatches",
        "debt_separation_cases",
        "bad_balances",
    )


def heavy_sb_counts(
    schedule: DataFrame, counterpart: DataFrame, tolerance: float, year_range: tuple[int, int] | None = YEAR_RANGE
) -> DataFrame:
    """The counters of the S-B summary for the rows given (cleaned ledgers)."""
    base = _side(counterpart, "day_b", year_range, v="bal_b")
    parts = _pair_parts(base, _side(schedule, "day_s", year_range, w="bal_s"), tolerance)
    of_b = counterpart.groupBy(KEY).agg(
        F.count(F.lit(1)).cast(WIDE).alias("nb"), _rows_if(~F.col("bad_balance_b")).alias("good_b")
    )
    of_s = schedule.groupBy(KEY).agg(
        F.count(F.lit(1)).cast(WIDE).alias("ns"), _rows_if(~F.col("bad_balance_s")).alias("good_s")
    )
    nb, ns = F.col("nb"), F.col("ns")
    row = of_b.join(of_s, KEY, "left").agg(
        _total(nb * ns).alias("_matched"),
        _total(F.when(ns.isNull(), nb)).alias("unmatched_b"),
        _total(nb * ns - F.col("good_s") * F.col("good_b")).alias("bad_balances"),
    )
    return _one(row, parts).select(
        *_classes(F.col("_matched"), F.col("_dates"), F.col("_balances"), F.col("_perfect")),
        "unmatched_b",
        "bad_balances",
    )


def heavy_three_counts(
    system: DataFrame,
    counterpart: DataFrame,
    schedule: DataFrame,
    tolerance: float,
    year_range: tuple[int, int] | None = YEAR_RANGE,
) -> DataFrame:
    """The class counts of the three-way comparison for the rows given."""
    base = _side(counterpart, "day_b", year_range, v="bal_b")
    # The first link of the balance chain concerns the system row alone.
    chained = system.where(cmp.within(F.col("bal_a"), F.col("exact_bal"), tolerance))
    of_a, of_s = _side(system, "day_a", year_range), _side(schedule, "day_s", year_range, w="bal_s")
    linked = _side(chained, "day_a", year_range, w="exact_bal")
    parts = {
        "matched": _same([base, of_a, of_s], [KEY]),
        "dates": _same([_dated(f) for f in (base, of_a, of_s)], [KEY, "day"]),
        "balances": _agreeing(base, [linked, of_s], [KEY], tolerance),
        "perfect": _agreeing(_dated(base), [_dated(linked), _dated(of_s)], [KEY, "day"], tolerance),
    }
    row = _one(counterpart.sparkSession.range(1), parts)
    return row.select(*_classes(*[F.col(f"_{n}") for n in ("matched", "dates", "balances", "perfect")]))

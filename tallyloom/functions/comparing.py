"""Comparison columns: date and balance agreement, classes and severities."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.parsing import YEAR_RANGE

# Default tolerance and the severity limits of a balance gap.
TOLERANCE = 0.01
SEVERITY_DANGER = 1000
SEVERITY_WARNING = 100

PERFECT, DATE_ONLY, BALANCE_ONLY, BOTH = "perfect", "date_only", "balance_only", "both"
CLASSES = [PERFECT, DATE_ONLY, BALANCE_ONLY, BOTH]


def dates_usable(*dates: Column, year_range: tuple[int, int] | None = YEAR_RANGE) -> Column:
    """All dates present and, with ``year_range``, within those years."""
    usable = F.lit(True)
    for date in dates:
        usable = usable & date.isNotNull()
        if year_range:
            usable = usable & F.coalesce(F.year(date).between(*year_range), F.lit(False))
    return usable


def dates_equal(left: Column, right: Column, usable: Column) -> Column:
    """False, never null, where either date is unusable."""
    return F.coalesce(usable & (left == right), F.lit(False))


def day_gap(left: Column, right: Column, usable: Column) -> Column:
    return F.when(usable, F.abs(F.datediff(right, left))).otherwise(F.lit(0))


def limit(tolerance: float | Decimal) -> Column:
    """A Decimal stays one, so that decimal balances are compared without rounding."""
    return F.lit(tolerance if isinstance(tolerance, Decimal) else float(tolerance))


def within(left: Column, right: Column, tolerance: float | Decimal) -> Column:
    return F.abs(left - right) <= limit(tolerance)


def gap_percent(gap: Column, base: Column, other: Column) -> Column:
    """Gap as a share of ``base`` in double; a zero base gives 100 unless both are zero."""
    return F.round(
        F.when(base != 0, F.abs(gap).cast("double") / F.abs(base).cast("double") * 100.0)
        .when(other != 0, F.lit(100.0))
        .otherwise(F.lit(0.0)),
        4,
    )


def mismatch_class(date_ok: Column, balance_ok: Column) -> Column:
    return (
        F.when(date_ok & balance_ok, F.lit(PERFECT))
        .when(balance_ok, F.lit(DATE_ONLY))
        .when(date_ok, F.lit(BALANCE_ONLY))
        .otherwise(F.lit(BOTH))
    )


def severity(gap: Column) -> Column:
    size = F.abs(gap)
    return (
        F.when(size > SEVERITY_DANGER, F.lit("danger"))
        .when(size > SEVERITY_WARNING, F.lit("warning"))
        .otherwise(F.lit("ok"))
    )


def percent(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent, zero where there is no whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")) * 100.0, F.lit(0.0))

"""Yearly repayment of a loan under three orders of allocation.

Each loan is folded on its own row over its list of due principals, so a schedule
needs no shuffle. The fold counts in whole hundredths, rounding half up at each step;
amounts become decimals again on the way out.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# Yearly interest, penalty on what was due and unpaid (in thousandths),
# and how many of the first years a short listing shows.
INTEREST_PER_MILLE = 10
PENALTY_PER_MILLE = 5
HEAD_YEARS = 3

OLD_FIELDS = [
    "year", "p_start", "interest", "p_due", "total_due", "penalty_accrued", "payment", "cut_penalty",
    "cut_interest", "cut_principal", "p_end", "p_due_unpaid",
]
INTERIM_FIELDS = [
    "year", "p_start", "interest", "p_due", "payment", "cut_principal", "p_end", "interest_unpaid",
    "penalty_unpaid",
]
NEW_FIELDS = [
    "year", "p_start", "interest", "p_due", "total_due", "payment", "cut_p_due", "cut_interest",
    "cut_penalty", "cut_p_extra", "p_end",
]


def _long(value: Column | int) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("bigint")


def _cents(value: Column) -> Column:
    return (value.cast(MONEY) * 100).cast("bigint")


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def _per_mille(cents: Column, rate: int) -> Column:
    """Rounded half up. A closed loan may give negative amounts; its years are dropped."""
    return F.call_function("div", cents * rate + 500, _long(1000))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _row(fields: list[str], **values: Column) -> Column:
    return F.struct(*[_long(values[f]).alias(f) for f in fields])


def _old_step(prev: Column, due: Column) -> Column:
    """Penalty, then interest, then principal; what was due and unpaid earns penalty."""
    begun = F.struct(
        (prev["year"] + 1).alias("year"),
        prev["p_end"].alias("opening"),
        prev["p_due_unpaid"].alias("carried"),
        prev["payment"].alias("payment"),
        _per_mille(prev["p_end"], INTEREST_PER_MILLE).alias("interest"),
        _per_mille(prev["p_due_unpaid"], PENALTY_PER_MILLE).alias("penalty"),
    )

    def finish(s: Column) -> Column:
        principal = s["payment"] - s["interest"] - s["penalty"]
        unpaid = s["carried"] + s["interest"] + due + s["penalty"] - s["payment"]
        return _row(
            OLD_FIELDS,
            year=s["year"],
            p_start=s["opening"],
            interest=s["interest"],
            p_due=due,
            total_due=s["interest"] + due,
            penalty_accrued=s["penalty"],
            payment=s["payment"],
            cut_penalty=s["penalty"],
            cut_interest=s["interest"],
            cut_principal=principal,
            p_end=s["opening"] - principal,
            p_due_unpaid=F.greatest(_long(0), unpaid),
        )

    return _let(begun, finish)


def _interim_step(prev: Column, due: Column) -> Column:
    """All of the payment to principal; interest piles up unpaid."""
    begun = F.struct(
        (prev["year"] + 1).alias("year"),
        prev["p_end"].alias("opening"),
        prev["payment"].alias("payment"),
        prev["interest_unpaid"].alias("piled"),
        _per_mille(prev["p_end"], INTEREST_PER_MILLE).alias("interest"),
        F.least(prev["payment"], prev["p_end"]).alias("principal"),
    )
    return _let(
        begun,
        lambda s: _row(
            INTERIM_FIELDS,
            year=s["year"],
            p_start=s["opening"],
            interest=s["interest"],
            p_due=due,
            payment=s["payment"],
            cut_principal=s["principal"],
            p_end=s["opening"] - s["principal"],
            interest_unpaid=s["piled"] + s["interest"],
            penalty_unpaid=_long(0),
        ),
    )


def _new_step(prev: Column, due: Column) -> Column:
    """Due principal, then interest, then extra principal; unpaid interest lapses."""
    begun = F.struct(
        (prev["year"] + 1).alias("year"),
        prev["p_end"].alias("opening"),
        prev["payment"].alias("payment"),
        F.least(prev["payment"], due).alias("cut_due"),
        _per_mille(prev["p_end"], INTEREST_PER_MILLE).alias("interest"),
    )

    def finish(s: Column) -> Column:
        cut_interest = F.least(s["payment"] - s["cut_due"], s["interest"])
        return _row(
            NEW_FIELDS,
            year=s["year"],
            p_start=s["opening"],
            interest=s["interest"],
            p_due=due,
            total_due=s["interest"] + due,
            payment=s["payment"],
            cut_p_due=s["cut_due"],
            cut_interest=cut_interest,
            cut_penalty=_long(0),
            cut_p_extra=s["payment"] - s["cut_due"] - cut_interest,
            p_end=s["opening"] - s["payment"] + cut_interest,
        )

    return _let(begun, finish)


SCENARIOS = {
    "old": (OLD_FIELDS, _old_step),
    "interim": (INTERIM_FIELDS, _interim_step),
    "new": (NEW_FIELDS, _new_step),
}


def waterfall(loans: DataFrame, scenario: str, keys: list[str]) -> DataFrame:
    """One row per loan and year.

    ``loans`` has ``loan`` and ``payment`` and ``due``, the due principals in year
    order. A schedule ends with the year that clears the loan or with the last due
    principal; that year is marked ``last_payment``.
    """
    fields, step = SCENARIOS[scenario]
    counted = loans.select(
        *keys,
        _cents(F.col("loan")).alias("_loan"),
        _cents(F.col("payment")).alias("_payment"),
        F.transform("due", _cents).alias("_due"),
    )
    known = {"p_end": F.col("_loan"), "payment": F.col("_payment")}
    start = F.array(_row(fields, **{f: known.get(f, F.lit(0)) for f in fields}))

    def add_year(state: Column, due: Column) -> Column:
        return F.concat(state, F.array(_let(F.element_at(state, -1), lambda prev: step(prev, due))))

    # Outer, because the planner guards an inner explode with a filter that would run the
    # fold again; the start row has no opening balance and goes with the closed years.
    rows = counted.select(
        *keys,
        F.size("_due").alias("_last"),
        F.explode_outer(F.aggregate("_due", start, add_year)).alias("y"),
    ).where(F.col("y.p_start") > 0)
    return rows.select(
        *keys,
        F.col("y.year").cast("int").alias("year"),
        *[_money(F.col(f"y.{f}")).alias(f) for f in fields if f != "year"],
        ((F.col("y.p_end") <= 0) | (F.col("y.year") == F.col("_last"))).alias("last_payment"),
    )


def head_and_tail(schedule: DataFrame, head: int = HEAD_YEARS) -> DataFrame:
    """The first years and the last one."""
    return schedule.where((F.col("year") <= head) | F.col("last_payment"))

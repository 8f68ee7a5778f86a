"""Two-way and three-way comparison of the ledgers on the normalised account key.

Every frame here counts joined rows: an account that occurs twice on one side gives
two rows. ``copies`` says how many joined rows a row stands for (see ``skew``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import comparing as cmp
from tallyloom.functions import parsing as ps
from tallyloom.operators.skew import (
    DEFAULT_GUARD,
    SkewGuard,
    balanced_join,
    balanced_join_all,
    expand_copies,
)

KEY = "acc_key"
DEBT_REMARK = "แยกหนี้ - PRE_BALANCE < EXACT_PRE_BALANCE"  # fixed value


# ---- cleaned inputs -------------------------------------------------------


def is_active(system: DataFrame) -> Column:
    """True for rows of the active group; for all rows of a ledger without the flag."""
    return ps.is_active_group("group_flag") if "group_flag" in system.columns else F.lit(True)


def active_only(system: DataFrame) -> DataFrame:
    return system.where(is_active(system))


def clean_system(system: DataFrame, money: str = "double") -> DataFrame:
    """Active system rows, parsed before the join so the shuffle carries typed values.

    ``money`` is the type of balances: ``double``, or a decimal for exact comparison.
    """
    exact = "exact_pre_balance" if "exact_pre_balance" in system.columns else "pre_balance"
    tidy = active_only(system).select(
        ps.account_key("acc_no").alias(KEY),
        F.col("acc_no").alias("acc_a"),
        ps.ledger_date_text("first_payment_date").alias("day"),
        ps.number_text("pre_balance").alias("pre"),
        ps.number_text(exact).alias("exact"),
    )
    zero = F.lit(0)
    return tidy.select(
        KEY, "acc_a", ps.read_ledger_date("day").alias("day_a"), ps.read_number("pre", money).alias("pre"),
        ps.read_number("exact", money).alias("exact"),
    ).select(
        KEY, "acc_a", "day_a", F.coalesce("pre", zero).alias("bal_a"),
        F.coalesce("exact", zero).alias("exact_bal"), F.col("pre").isNull().alias("bad_balance_a"),
    )


def clean_counterpart(deduped: DataFrame) -> DataFrame:
    """Counterpart rows after ``dedup``, whose balance is a number already."""
    tidy = deduped.withColumns({KEY: ps.account_key("acc_no"), "day": ps.strip("start_date_be")})
    return tidy.select(
        KEY,
        F.col("acc_no").alias("acc_b"),
        F.col("start_date_be").alias("date_b"),
        ps.read_buddhist_date("day").alias("day_b"),
        F.coalesce("loan_balance", F.lit(0)).alias("bal_b"),
        F.col("loan_balance").isNull().alias("bad_balance_b"),
    )


def clean_schedule(schedule: DataFrame, first_only: bool = False, money: str = "double") -> DataFrame:
    """Schedule rows; ``first_only`` keeps the earliest due date of each account."""
    tidy = schedule.select(
        ps.account_key("acc_no").alias(KEY),
        F.col("acc_no").alias("acc_s"),
        ps.schedule_date_text("due_payment_date").alias("day"),
        ps.number_text("capital_remain").alias("capital"),
    )
    cleaned = tidy.select(
        KEY, "acc_s", ps.read_schedule_date("day").alias("day_s"), ps.read_number("capital", money).alias("capital")
    ).select(
        KEY, "acc_s", "day_s", F.coalesce("capital", F.lit(0)).alias("bal_s"),
        F.col("capital").isNull().alias("bad_balance_s"),
    )
    if not first_only:
        return cleaned
    # min() combines on the map side, so a long schedule never sits in one task.
    row = F.struct(F.col("day_s").isNull().alias("undated"), "day_s", "bal_s", "acc_s", "bad_balance_s")
    first = cleaned.groupBy(KEY).agg(F.min(row).alias("m"))
    return first.select(KEY, "m.acc_s", "m.day_s", "m.bal_s", "m.bad_balance_s")


def one_per_account(cleaned: DataFrame, *order: str) -> DataFrame:
    """Account grain: the first row of each key in the given order."""
    rest = [c for c in cleaned.columns if c != KEY and c not in order]
    row = F.struct(*order, *rest)
    return cleaned.groupBy(KEY).agg(F.min(row).alias("m")).select(KEY, "m.*").select(*cleaned.columns)


# ---- two-way --------------------------------------------------------------


def _compare(joined, other, day, balance, tolerance, year_range):
    usable = cmp.dates_usable(F.col(day), F.col("day_b"), year_range=year_range)
    gap = F.col("bal_b") - F.col(balance)
    compared = joined.withColumns(
        {
            "matched": F.col(other).isNotNull(),
            "dates_usable": usable,
            "date_match": cmp.dates_equal(F.col(day), F.col("day_b"), usable),
            "date_diff_days": cmp.day_gap(F.col(day), F.col("day_b"), usable),
            "bal_diff": gap,
            "bal_diff_pct": cmp.gap_percent(gap, F.col(balance), F.col("bal_b")),
            "bal_match": F.abs(gap) <= cmp.limit(tolerance),
        }
    )
    return compared.withColumn(
        "mismatch", F.when(F.col("matched"), cmp.mismatch_class(F.col("date_match"), F.col("bal_match")))
    )


def compare_ab(
    system: DataFrame,
    counterpart: DataFrame,
    tolerance: float = cmp.TOLERANCE,
    year_range: tuple[int, int] | None = None,
    guard: SkewGuard | None = DEFAULT_GUARD,
    heavy: Sequence[list] | None = None,
) -> DataFrame:
    """Counterpart rows with their system rows; unmatched rows stay, ``matched`` false.

    The system date is not range-checked unless ``year_range`` is given.
    """
    joined = balanced_join(counterpart, system, KEY, "left", guard, heavy)
    compared = _compare(joined, "acc_a", "day_a", "bal_a", tolerance, year_range)
    return compared.withColumns(
        {
            "exact_vs_b_diff": F.col("bal_b") - F.col("exact_bal"),
            "exact_vs_pre_diff": F.col("bal_a") - F.col("exact_bal"),
            "exact_vs_b_match": cmp.within(F.col("bal_b"), F.col("exact_bal"), tolerance),
            "exact_vs_pre_match": cmp.within(F.col("bal_a"), F.col("exact_bal"), tolerance),
            "is_debt_separation": F.col("bal_a") < F.col("exact_bal"),
        }
    )


def compare_sb(
    schedule: DataFrame,
    counterpart: DataFrame,
    tolerance: float = cmp.TOLERANCE,
    year_range: tuple[int, int] | None = ps.YEAR_RANGE,
    guard: SkewGuard | None = DEFAULT_GUARD,
    heavy: Sequence[list] | None = None,
) -> DataFrame:
    joined = balanced_join(counterpart, schedule, KEY, "left", guard, heavy)
    return _compare(joined, "acc_s", "day_s", "bal_s", tolerance, year_range)


AB_COLUMNS = [
    "acc_no", "date_a", "date_b", "date_match", "date_diff_days", "bal_a", "bal_b", "bal_match",
    "bal_diff", "bal_diff_pct", "exact_bal", "exact_vs_b_diff", "exact_vs_pre_diff",
    "is_debt_separation",
]
SB_COLUMNS = [
    "acc_no", "date_s", "date_b", "date_match", "date_diff_days", "bal_s", "bal_b", "bal_match",
    "bal_diff", "bal_diff_pct",
]


def ab_rows(compared: DataFrame, errors_only: bool = False) -> DataFrame:
    """Matched rows, or only those that disagree, in the output layout."""
    return _rows(compared, errors_only, "acc_b", {"date_a": "day_a"}, AB_COLUMNS)


def sb_rows(compared: DataFrame, errors_only: bool = False) -> DataFrame:
    return _rows(compared, errors_only, "acc_b", {"date_s": "day_s"}, SB_COLUMNS)


def _rows(compared, errors_only, account, iso, columns):
    rows = expand_copies(compared.where(is_error() if errors_only else F.col("matched")))
    named = rows.withColumn("acc_no", F.col(account))
    for name, day in iso.items():
        named = named.withColumn(name, ps.iso_text(day))
    return named.select(*columns, "mismatch")


def is_error():
    return F.col("matched") & (F.col("mismatch") != cmp.PERFECT)


def debt_separation(compared: DataFrame) -> DataFrame:
    """Matched rows whose balance is below the exact balance, with the fixed remark."""
    return expand_copies(compared.where(F.col("matched") & F.col("is_debt_separation"))).select(
        F.col("acc_b").alias("acc_no"),
        F.col("bal_a").alias("pre_balance"),
        F.col("exact_bal").alias("exact_pre_balance"),
        F.col("exact_vs_pre_diff").alias("difference"),
        F.col("bal_b").alias("balance_b"),
        F.lit(DEBT_REMARK).alias("remark"),
    )


# ---- three-way ------------------------------------------------------------


def compare_three(
    system: DataFrame,
    counterpart: DataFrame,
    schedule: DataFrame,
    tolerance: float = cmp.TOLERANCE,
    year_range: tuple[int, int] | None = ps.YEAR_RANGE,
    guard: SkewGuard | None = DEFAULT_GUARD,
    heavy: Sequence[list] | None = None,
) -> DataFrame:
    """Rows of accounts found in all three ledgers; both joins share the key's shuffle."""
    joined = balanced_join_all([system, counterpart, schedule], KEY, guard, heavy)
    usable = cmp.dates_usable(F.col("day_a"), F.col("day_b"), F.col("day_s"), year_range=year_range)
    dates = cmp.dates_equal(F.col("day_a"), F.col("day_b"), usable) & cmp.dates_equal(
        F.col("day_b"), F.col("day_s"), usable
    )
    # A chain, not all pairs: pre ~ exact, exact ~ B, B ~ S.
    balances = (
        cmp.within(F.col("bal_a"), F.col("exact_bal"), tolerance)
        & cmp.within(F.col("exact_bal"), F.col("bal_b"), tolerance)
        & cmp.within(F.col("bal_b"), F.col("bal_s"), tolerance)
    )
    return joined.withColumns(
        {"all_dates_match": dates, "all_balances_match": balances, "mismatch": cmp.mismatch_class(dates, balances)}
    )


THREE_COLUMNS = [
    "acc_no", "date_a", "date_b", "date_s", "bal_a_pre", "bal_a_exact", "bal_b", "bal_s",
    "all_dates_match", "all_balances_match",
]


def three_rows(compared: DataFrame, kind: str | None = None) -> DataFrame:
    """Listing tagged ``perfect`` or ``discrepancy``; ``kind`` keeps one of them."""
    tagged = compared.withColumn(
        "kind", F.when(F.col("mismatch") == cmp.PERFECT, F.lit("perfect")).otherwise(F.lit("discrepancy"))
    )
    if kind:
        tagged = tagged.where(F.col("kind") == kind)
    return (
        expand_copies(tagged)
        .withColumns(
            {
                "acc_no": F.col("acc_a"),
                "date_a": ps.iso_text("day_a"),
                "date_s": ps.iso_text("day_s"),
                "bal_a_pre": F.col("bal_a"),
                "bal_a_exact": F.col("exact_bal"),
            }
        )
        .select("kind", *THREE_COLUMNS)
    )

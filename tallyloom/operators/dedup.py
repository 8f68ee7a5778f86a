"""Exact duplicates and conflicting accounts of the counterpart ledger.

Account text is compared stripped but not normalised, the date as raw text, the
balance as a number. A missing account is its own row but never a conflict.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.parsing import number_text, read_number, strip
from tallyloom.operators.skew import DEFAULT_GUARD, SkewGuard, balanced_join, expand_copies, heavy_keys

IDENTITY = ["acc_no", "start_date_be", "loan_balance"]


def typed_counterpart(raw: DataFrame, money: str = "double") -> DataFrame:
    """Account stripped, balance as number (null if unreadable), date left as text."""
    tidy = raw.withColumns({"acc_no": strip("acc_no"), "loan_balance": number_text("loan_balance")})
    return tidy.withColumn("loan_balance", read_number("loan_balance", money))


def dedup(typed: DataFrame) -> DataFrame:
    """Distinct (account, date, balance); copies are dropped before the shuffle."""
    return typed.select(*IDENTITY).distinct()


def first_rows(typed: DataFrame, order: Sequence[str] = ("source_file",), into: str = "copies") -> DataFrame:
    """The first row of each (account, date, balance), with what else it holds, and how many copies there were.

    ``order`` says which row is first, in files ``read_extract(…, with_place=True)`` the file's name
    and the row's place in it; of rows equal in it the least. Rows meet as one candidate per
    task, so a row with very many copies is never gathered. Null cells equal each other.
    """
    rest = [c for c in typed.columns if c not in IDENTITY and c not in order]
    row = F.struct(*order, *rest)
    first = typed.groupBy(*IDENTITY).agg(F.min(row).alias("_first"), F.count(F.lit(1)).alias(into))
    return first.select(*IDENTITY, "_first.*", into).select(*typed.columns, into)


def _per_account(typed: DataFrame) -> DataFrame:
    """Per account: rows, and distinct (date, balance) pairs counting nulls as equal."""
    pairs = typed.groupBy(*IDENTITY).agg(F.count(F.lit(1)).alias("rows"))
    return pairs.groupBy("acc_no").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("pairs"))


def _in_conflict() -> Column:
    return F.col("acc_no").isNotNull() & (F.col("pairs") > 1)


def conflict_accounts(typed: DataFrame) -> DataFrame:
    return _per_account(typed).where(_in_conflict()).select("acc_no", "rows", "pairs")


def conflict_records(typed: DataFrame, guard: SkewGuard | None = DEFAULT_GUARD) -> DataFrame:
    """Every row, before dedup, of the accounts in conflict."""
    accounts = conflict_accounts(typed).select("acc_no")
    # One row per account on the right: only the left side can be heavy.
    heavy = [heavy_keys([typed], "acc_no", guard)[0], []] if guard else [[], []]
    return expand_copies(balanced_join(typed, accounts, "acc_no", "inner", guard, heavy))


def dedup_report(typed: DataFrame) -> DataFrame:
    conflict = _in_conflict()
    return (
        _per_account(typed)
        .agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("original_rows"),
            F.coalesce(F.sum("pairs"), F.lit(0)).alias("kept_rows"),
            F.count_if(conflict).alias("conflict_accounts"),
            F.coalesce(F.sum(F.when(conflict, F.col("rows"))), F.lit(0)).alias("conflict_records"),
        )
        .withColumn("removed_rows", F.col("original_rows") - F.col("kept_rows"))
    )

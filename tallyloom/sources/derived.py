"""Raw text ledgers derived from the star-schema tables.

Three views of the same loans, one per order, as text the way extracts hold them:
the system ledger A, the counterpart ledger B (two source files, exact copies and
conflicting copies, Buddhist-Era dates) and the schedule S (three date layouts).
Accounts missing from another ledger carry a prefix instead of being left out.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.parsing import buddhist_text


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def _money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def _every(n: int) -> Column:
    return F.col("o_orderkey") % n == 0


def _date() -> Column:
    return F.col("o_orderdate").cast("date")


#: The account that takes every ``hot``-th order, where one is asked for.
HOT = "H1"


def _account(number: Column, hot: int | None) -> Column:
    return F.when(_every(hot), F.lit(HOT)).otherwise(number) if hot else number


def system_ledger(orders: DataFrame, hot: int | None = None) -> DataFrame:
    balance = _money(F.col("o_totalprice"))
    extra = F.when(_every(11), F.lit(100)).otherwise(F.lit(0))
    return orders.select(
        _account(F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), hot).alias("acc_no"),
        F.when(_every(7), F.lit("0")).otherwise(F.lit("1")).alias("group_flag"),
        F.concat(_date().cast("string"), F.lit(" 00:00:00")).alias("first_payment_date"),
        balance.cast("string").alias("pre_balance"),
        _money(balance + extra).cast("string").alias("exact_pre_balance"),
    )


def counterpart_ledger(orders: DataFrame, hot: int | None = None) -> DataFrame:
    key = F.col("o_orderkey")
    account = F.when(_every(13), F.concat(F.lit("B"), key.cast("string"))).otherwise(key.cast("string"))
    # Some rows have no account, an account of zeros, an unreadable balance or no such day.
    account = F.when(_every(97), F.lit(None)).when(_every(101), F.lit("000")).otherwise(account)
    account = _account(account, hot)
    shifted = F.when(_every(5), F.date_add(_date(), 30)).otherwise(_date())
    gap = F.when(_every(3), F.lit("250.75")).otherwise(F.lit("0.00")).cast("decimal(18,2)")
    balance = _money(_money(F.col("o_totalprice")) + gap)

    # One row per copy of a loan: the original, a copy, a conflicting copy.
    def copy(file: str, more: int) -> Column:
        return F.struct(F.lit(file).alias("file"), F.lit(more).alias("more"))

    copies = F.concat(
        F.array(copy("part1.csv", 0)),
        F.when(_every(19), F.array(copy("part2.csv", 0))).otherwise(F.array()),
        F.when(_every(23), F.array(copy("part2.csv", 1))).otherwise(F.array()),
    )
    return (
        orders.select(key.alias("k"), account.alias("acc_no"), shifted.alias("dt"), balance.alias("bal"), F.explode(copies).alias("c"))
        .select(
            "acc_no",
            F.when(F.col("k") % 89 == 0, F.lit("30/02/2567")).otherwise(buddhist_text("dt")).alias("start_date_be"),
            F.when(F.col("k") % 83 == 0, F.lit("N/A"))
            .otherwise(_money(F.col("bal") + F.col("c.more")).cast("string"))
            .alias("loan_balance"),
            F.col("c.file").alias("source_file"),
        )
    )


def schedule_ledger(orders: DataFrame, hot: int | None = None) -> DataFrame:
    key = F.col("o_orderkey")
    account = F.when(_every(4), F.concat(F.lit("S"), key.cast("string"))).otherwise(key.cast("string"))
    due = F.when(_every(6), F.date_add(_date(), 15)).otherwise(_date())
    extra = F.when(_every(9), F.lit(500)).otherwise(F.lit(0))
    return orders.select(
        F.concat(F.lit(" 00"), _account(account, hot)).alias("acc_no"),
        F.when(key % 4 == 1, F.date_format(due, "yyyy-MM-dd"))
        .when(key % 4 == 2, F.date_format(due, "dd/MM/yyyy"))
        .otherwise(F.date_format(due, "yyyy/MM/dd"))
        .alias("due_payment_date"),
        _money(_money(F.col("o_totalprice")) + extra).cast("string").alias("capital_remain"),
    )

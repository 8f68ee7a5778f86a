"""Balances compared in decimals."""

from decimal import Decimal

from conftest import one
from pyspark.sql import functions as F

from tallyloom.operators import matching as mt
from tallyloom.operators import summary as sm
from tallyloom.operators.skew import SkewGuard
from tallyloom.plans.reconcile import EXACT_MONEY, Reconciliation

A = "acc_no string, first_payment_date string, pre_balance string"
B = "acc_no string, start_date_be string, loan_balance string, source_file string"


def ledgers(spark, pairs):
    a = spark.createDataFrame([(str(k), "2024-07-05", x) for k, x, _ in pairs], A)
    return a, spark.createDataFrame([(str(k), "05/07/2567", y, "p") for k, _, y in pairs], B)


def test_a_gap_of_exactly_the_tolerance_agrees(spark):
    """In binary, 0.30 - 0.29 and 1000000.03 - 1000000.02 are more than 0.01."""
    pairs = [(1, "0.29", "0.30"), (2, "1,000,000.02", "1000000.03"), (3, "1.00", "1.0101"), (4, "0.1", "x"), (5, "12345678901234567890.01", "12345678901234567890.02")]
    exact = Reconciliation(*ledgers(spark, pairs), money=EXACT_MONEY)
    rows = {r.acc_no: r for r in mt.ab_rows(exact.ab).collect()}
    assert [rows[str(k)].bal_match for k in (1, 2, 3, 4, 5)] == [True, True, False, False, True]
    assert rows["2"].bal_diff == Decimal("0.0100") and rows["3"].bal_diff == Decimal("0.0101") and rows["4"].bal_diff == Decimal("-0.1000")
    plain = {r.acc_no: r.bal_match for r in mt.ab_rows(Reconciliation(*ledgers(spark, pairs)).ab).collect()}
    assert not plain["1"] and not plain["2"]


def test_heavy_accounts_are_counted_in_decimals(spark):
    """Counters by group equal the joined rows, at gaps of the tolerance and in negative cells."""
    values = [f"{sign}{k / 100:.2f}" for k in range(0, 40) for sign in ("", "-")]
    a = spark.createDataFrame([("7", f"2024-07-{1 + k % 3:02d}", v) for k, v in enumerate(values * 2)], A)
    b = spark.createDataFrame([("7", f"0{1 + k % 2}/07/2567", v, "p") for k, v in enumerate(values)], B)
    by_group = Reconciliation(a, b, guard=SkewGuard(min_rows=10), money=EXACT_MONEY)
    by_row = Reconciliation(a, b, guard=None, money=EXACT_MONEY)
    assert len(by_group.ab_counted) == 2
    counts = {k: int(v) for k, v in one(sm.class_counts(*by_group.ab_counted)).items()}
    assert counts == one(sm.class_counts(*by_row.ab_counted))
    cents = [round(float(v) * 100) for v in values]
    near = sum(abs(x - y) <= 1 for x in cents * 2 for y in set(cents) | {0})
    assert counts["perfect"] + counts["date_only"] > 0 and counts["matched_rows"] == 2 * len(values) * by_group.b.count()
    assert near > 0


def test_statistics_and_three_ways(spark, mini):
    for money in ("double", EXACT_MONEY):
        r = Reconciliation(*mini, money=money)
        assert one(sm.balance_error_stats(r.ab))["p95"] == 4.325
        three = one(r.three_summary)
        assert (three["matched_rows"], three["perfect"], three["both"]) == (3, 1, 2)
        assert one(r.sb_summary)["perfect"] == 2 and one(r.dedup_report)["conflict_accounts"] == 1
        bins = sm.error_histogram(r.ab).agg(F.sum("rows")).first()[0]
        assert bins == 3

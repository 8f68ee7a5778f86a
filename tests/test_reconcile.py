import os

import pytest
from conftest import one
from pyspark.sql import functions as F

from tallyloom.operators import dedup as dd
from tallyloom.operators import matching as mt
from tallyloom.operators import summary as sm
from tallyloom.plans.reconcile import Reconciliation
from tallyloom.sources import derived as dv


@pytest.fixture(scope="module")
def run(mini):
    return Reconciliation(*mini)


def subset(row, **wanted):
    assert {k: row[k] for k in wanted} == wanted


def test_dedup(run):
    subset(
        one(run.dedup_report),
        original_rows=7, kept_rows=6, removed_rows=1, conflict_accounts=1, conflict_records=3,
    )
    records = dd.conflict_records(run.typed).collect()
    assert sorted((r.acc_no, r.start_date_be, r.loan_balance, r.source_file) for r in records) == [
        ("5", "05/07/2567", 500.5, "part1.csv"),
        ("5", "05/07/2567", 500.5, "part2.csv"),
        ("5", "06/07/2567", 500.0, "part2.csv"),
    ]
    again = dd.typed_counterpart(dd.dedup(run.typed).withColumn("loan_balance", F.col("loan_balance").cast("string")))
    assert one(dd.dedup_report(again))["removed_rows"] == 0


def test_missing_account_is_never_a_conflict(spark):
    rows = [(None, "05/07/2567", "1"), (None, "06/07/2567", "2"), ("7", None, "1"), ("7", None, "1")]
    typed = dd.typed_counterpart(spark.createDataFrame(rows, "acc_no string, start_date_be string, loan_balance string"))
    subset(one(dd.dedup_report(typed)), kept_rows=3, conflict_accounts=0, conflict_records=0)
    assert dd.conflict_records(typed).count() == 0


def test_ab_counts(run):
    subset(
        one(run.ab_summary),
        rows_a=5, active_rows_a=4, rows_b=6, matched_rows=5, unmatched_b=1, perfect=1, date_only=2,
        balance_only=1, both=1, match_rate_pct=83.33, error_rate_pct=80.0, accuracy_rate_pct=20.0,
        exact_vs_b_mismatches=3, exact_vs_pre_mismatches=1, debt_separation_cases=1,
    )


def test_ab_rows(run):
    rows = {(r.acc_no, r.bal_b): r for r in mt.ab_rows(run.ab).collect()}
    four = rows["4", 5.0]
    assert (four.date_match, four.date_diff_days, four.bal_diff, four.bal_diff_pct) == (False, 0, 5.0, 100.0)
    assert (four.date_a, four.date_b, four.mismatch) == ("", "30/02/2567", "both")
    five = rows["5", 500.5]
    assert (five.bal_diff, five.bal_diff_pct, five.date_match) == (0.5, 0.1, True)
    assert mt.ab_rows(run.ab, errors_only=True).count() == 4


def test_debt_separation(run):
    row = one(mt.debt_separation(run.ab))
    subset(row, acc_no="2", difference=-500.0, pre_balance=2000.0, exact_pre_balance=2500.0)


def test_error_stats(run):
    assert one(sm.balance_error_stats(run.ab)) == {
        "n": 4, "mean": 1.375, "median": 0.25, "std": 2.1028, "min": 0.0, "max": 5.0, "p95": 4.325, "p99": 4.865,
    }
    assert one(sm.date_diff_stats(run.ab)) == {
        "n": 3, "mean": 0.6667, "median": 1.0, "std": 0.4714, "min": 0.0, "max": 1.0,
    }
    subset(one(sm.approximate_stats(run.ab)), n=4, mean=1.375, min=0.0, max=5.0)


def test_quality(run):
    assert one(sm.quality_metrics(run.ab_summary)) == {
        "integrity": 25.0, "coverage": 83.3, "date_accuracy": 60.0, "balance_accuracy": 80.0,
    }


def test_schedule(run):
    subset(one(run.sb_summary), matched_rows=3, unmatched_b=4, perfect=2, date_only=0, balance_only=0, both=1)
    wrong = one(mt.sb_rows(run.sb, errors_only=True))
    subset(wrong, acc_no="1", date_diff_days=31, bal_diff=100.0, date_s="2024-08-05")


def test_first_due_date_only(mini):
    subset(one(Reconciliation(*mini, first_due_only=True).sb_summary), matched_rows=2, perfect=2)


def test_three_way(run):
    subset(one(run.three_summary), matched_rows=3, perfect=1, both=2, date_only=0, balance_only=0)
    assert {r.kind: r["count"] for r in mt.three_rows(run.three).groupBy("kind").count().collect()} == {
        "perfect": 1, "discrepancy": 2,
    }
    assert {r.acc_no for r in mt.three_rows(run.three).collect()} == {"0001", "0002"}


def test_presence(run):
    # Account 3 is in the system ledger but not active.
    buckets = {(r.in_a, r.in_b, r.in_s): r["keys"] for r in run.presence().collect()}
    assert buckets == {(True, True, True): 2, (True, True, False): 2, (False, True, False): 1, (False, False, True): 1}


def test_matrix(run):
    rows = {r.metric: (r.a_vs_b, r.s_vs_b, r.three_way) for r in run.matrix().collect()}
    assert rows["matched_rows"] == (5, 3, 3)
    assert rows["source_rows"] == (5, 4, None)
    assert rows["counterpart_rows"] == (6, 6, None)
    assert rows["conflict_accounts"] == (1, None, None)
    assert len(rows) == 9


def test_without_schedule_and_optional_columns(mini):
    a, b, _ = mini
    bare = a.drop("group_flag", "exact_pre_balance")
    r = Reconciliation(bare, b)
    row = one(r.ab_summary)
    subset(row, active_rows_a=5, matched_rows=6, exact_vs_pre_mismatches=0, debt_separation_cases=0)
    assert {m.metric: m.s_vs_b for m in r.matrix().collect()}["matched_rows"] is None


def test_no_match_at_all(spark, mini):
    a, b, s = mini
    other = b.withColumn("acc_no", F.concat(F.lit("Z"), "acc_no"))
    r = Reconciliation(a, other, s)
    subset(one(r.ab_summary), matched_rows=0, perfect=0, both=0, match_rate_pct=0.0, accuracy_rate_pct=0.0)
    assert one(sm.balance_error_stats(r.ab))["p99"] == 0.0
    assert sm.error_histogram(r.ab).count() == 0
    subset(one(r.three_summary), matched_rows=0, perfect_match_rate_pct=0.0)


def test_missing_and_empty_accounts(spark, mini):
    a, b, s = mini
    more_a = a.union(spark.createDataFrame([("000", "1", "2024-07-05", "1", "1"), (None, "1", "2024-07-05", "1", "1")], a.schema))
    more_b = b.union(spark.createDataFrame([("0", "05/07/2567", "1", "x"), (None, "05/07/2567", "1", "x")], b.schema))
    row = one(Reconciliation(more_a, more_b, s).ab_summary)
    # All-zero accounts share the empty key and match; a missing account never does.
    subset(row, rows_b=8, matched_rows=6, unmatched_b=2, perfect=2, rows_b_no_key=1, rows_b_empty_key=1)


def test_tolerance_is_honoured(mini):
    subset(one(Reconciliation(*mini, tolerance=0.5).ab_summary), perfect=2, balance_only=0)


def test_account_grain(mini):
    row = one(Reconciliation(*mini, grain="account").ab_summary)
    subset(row, rows_b=5, matched_rows=4, unmatched_b=1)


def test_unreadable_balances_count_as_zero(spark, mini):
    a, b, s = mini
    bad = b.union(spark.createDataFrame([("4", "05/07/2567", "abc", "x")], b.schema))
    row = one(Reconciliation(a, bad, s).ab_summary)
    subset(row, bad_balances=1, matched_rows=6)


def test_known_counts_of_the_derived_ledgers(spark):
    """Counts worked out beforehand for the middle-sized tables."""
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("tables are not here")
    orders = dv.table(spark, folder, "orders")
    r = Reconciliation(dv.system_ledger(orders), dv.counterpart_ledger(orders), dv.schedule_ledger(orders))
    subset(one(r.ab_summary), matched_rows=12128, perfect=6060, date_only=1602, balance_only=3533, both=933, debt_separation_cases=1104)
    subset(one(r.ab_summary), rows_b_no_key=161, rows_b_empty_key=153, bad_balances=141, unmatched_b=3517)
    subset(one(r.sb_summary), matched_rows=10612, perfect=5302, date_only=1402, balance_only=2159, both=1749, bad_balances=123)
    subset(one(r.three_summary), matched_rows=9096, perfect=4124, date_only=1097, balance_only=2271, both=1604)
    assert one(sm.balance_error_stats(r.ab))["p95"] == 250.75

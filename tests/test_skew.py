"""A key that holds a third of all rows must change the plan, never the result."""

from collections import Counter

import pytest
from conftest import one
from pyspark.sql import functions as F

from tallyloom.operators import dedup as dd
from tallyloom.operators import matching as mt
from tallyloom.operators import presence as pr
from tallyloom.operators import summary as sm
from tallyloom.operators.skew import (
    SkewGuard,
    balanced_join,
    balanced_join_all,
    expand_copies,
    heavy_keys,
)
from tallyloom.plans.reconcile import Reconciliation
from tallyloom.sources import derived as dv

EAGER = SkewGuard(min_rows=20, salts=4)


def frames(spark):
    left = [("hot", i % 7) for i in range(60)] + [(f"k{i % 40}", i) for i in range(80)] + [(None, i) for i in range(40)]
    left += [("lonely", i) for i in range(50)]
    right = [("hot", i % 5) for i in range(40)] + [(f"k{i % 50}", i) for i in range(60)] + [(None, 1)] * 5
    right += [("right", i) for i in range(45)] + [("k1", 0)] * 30
    return (
        spark.createDataFrame(left, "k string, x int"),
        spark.createDataFrame(right, "k string, y int"),
    )


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_heavy_keys_are_found(spark):
    left, right = frames(spark)
    found_left, found_right = heavy_keys([left, right], "k", EAGER)
    assert set(found_left) == {"hot", "lonely"}
    assert set(found_right) == {"hot", "right", "k1"}
    assert heavy_keys([left], "k") == [[]]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_balanced_join_equals_plain_join(spark, how):
    left, right = frames(spark)
    expected = bag(left.join(right, "k", how).select("k", "x", "y"))
    assert bag(expand_copies(balanced_join(left, right, "k", how, EAGER))) == expected
    assert bag(expand_copies(balanced_join(left, right, "k", how, None))) == expected
    odd = [["hot", "k3"], ["k5", "absent"]]
    assert bag(expand_copies(balanced_join(left, right, "k", how, EAGER, odd))) == expected


def test_copies_collapse_before_the_join(spark):
    left, right = frames(spark)
    joined = balanced_join(left, right, "k", "inner", EAGER).where("k = 'hot'")
    assert joined.count() == 7 * 5
    assert joined.agg(F.sum("copies")).first()[0] == 60 * 40


def test_three_frames(spark):
    left, right = frames(spark)
    third = spark.createDataFrame([("hot", i) for i in range(30)] + [(f"k{i}", i) for i in range(30)], "k string, z int")
    expected = bag(left.join(right, "k").join(third, "k").select("k", "x", "y", "z"))
    assert bag(expand_copies(balanced_join_all([left, right, third], "k", EAGER))) == expected


def test_many_copies_expand_in_steps(spark):
    df = spark.range(1).select(F.lit(250_001).cast("bigint").alias("copies"))
    assert expand_copies(df.withColumn("v", F.lit(1))).count() == 250_001


def test_null_keys_spread(spark):
    left, right = frames(spark)
    expected = bag(left.join(right, "k", "left_anti").select("k", "x"))
    assert bag(pr.without_partner(left, right, "k")) == expected
    assert bag(pr.without_partner(left, right, "k", ["hot", "lonely"])) == expected


@pytest.fixture(scope="module")
def hot_ledgers(spark, folder):
    """A third of each ledger under one account, partly exact copies."""
    orders = dv.table(spark, folder, "orders").where("o_orderkey < 300")

    def heat(df):
        return df.withColumn("acc_no", F.when(F.crc32(F.concat_ws("|", *df.columns)) % 3 == 0, "777").otherwise(F.col("acc_no")))

    a, b, s = (heat(f(orders)) for f in (dv.system_ledger, dv.counterpart_ledger, dv.schedule_ledger))
    return a.union(a.where("acc_no = '777'")), b, s


def test_reconciliation_is_the_same_with_and_without_guard(hot_ledgers):
    guarded = Reconciliation(*hot_ledgers, guard=EAGER)
    plain = Reconciliation(*hot_ledgers, guard=None)
    assert guarded.heavy("a", "b", "s") == [["777"]] * 3
    for name in ("ab_summary", "sb_summary", "three_summary"):
        assert one(getattr(guarded, name)) == one(getattr(plain, name))
    heavy_only = guarded.ab_counted[1]
    assert one(heavy_only)["matched_rows"] > 1000
    assert one(sm.class_counts(*guarded.three_counted)) == one(sm.class_counts(guarded.three))
    assert one(sm.exact_balance_checks(*guarded.ab_counted)) == one(sm.exact_balance_checks(plain.ab))
    assert bag(mt.ab_rows(guarded.ab)) == bag(mt.ab_rows(plain.ab))
    assert bag(dd.conflict_records(guarded.typed, EAGER)) == bag(dd.conflict_records(plain.typed, None))


@pytest.mark.parametrize("tolerance", [0.0, 0.01, 40.0])
def test_counters_of_a_heavy_key_equal_brute_force(spark, tolerance):
    """Days and balances drawn from few values, some missing, some out of range."""
    import random

    rng = random.Random(11)
    days = ["2024-07-05", "2024-07-06", "-", "2336-01-01"]
    be = ["05/07/2567", "06/07/2567", "30/02/2567", "07/07/2567"]
    money = ["100", "100.01", "100.02", "100.005", "abc", "0", "-35.5", "140"]
    keys = ["hot"] * 3 + ["k1", "k2", None]
    pick = rng.choice
    a = [(pick(keys), "1", pick(days), pick(money), pick(money)) for _ in range(200)]
    b = [(pick(keys), pick(be), pick(money), "f") for _ in range(150)] + [("only_b", be[0], "1", "f")] * 3
    s = [(pick(keys), pick(days), pick(money)) for _ in range(120)]
    raw = (
        spark.createDataFrame(a, "acc_no string, group_flag string, first_payment_date string, pre_balance string, exact_pre_balance string"),
        spark.createDataFrame(b, "acc_no string, start_date_be string, loan_balance string, source_file string"),
        spark.createDataFrame(s, "acc_no string, due_payment_date string, capital_remain string"),
    )
    guarded = Reconciliation(*raw, tolerance=tolerance, guard=SkewGuard(min_rows=3, salts=3))
    plain = Reconciliation(*raw, tolerance=tolerance, guard=None)
    assert "hot" in guarded.heavy("a")[0] and "only_b" in guarded.heavy("b")[0]
    for name in ("ab_summary", "sb_summary", "three_summary"):
        assert one(getattr(guarded, name)) == one(getattr(plain, name))
    assert one(sm.balance_error_stats(guarded.ab)) == one(sm.balance_error_stats(plain.ab))
    assert one(sm.date_diff_stats(guarded.ab)) == one(sm.date_diff_stats(plain.ab))


def test_counters_of_one_account_pass_a_bigint(spark):
    """2.2 million rows of one account in each ledger: their product is above 2^63."""
    from tallyloom.operators import paircounts as pc

    n = 2_200_000
    day = "date'2024-07-05'"
    rows = spark.range(n)
    a = rows.selectExpr("'1' acc_key", f"{day} day_a", "10.0D bal_a", "10.0D exact_bal", "false bad_balance_a")
    b = rows.selectExpr("'1' acc_key", f"{day} day_b", "if(id < 1000000, 10.0D, 99.0D) bal_b", "false bad_balance_b")
    s = rows.selectExpr("'1' acc_key", f"{day} day_s", "10.0D bal_s", "false bad_balance_s")
    row = pc.heavy_three_counts(a, b, s, 0.01).first()
    assert int(row.matched_rows) == n**3 and int(row.perfect) == 1_000_000 * n * n
    two = pc.heavy_ab_counts(a, b, 0.01).first()
    assert int(two.matched_rows) == n * n and int(two.perfect) == 1_000_000 * n

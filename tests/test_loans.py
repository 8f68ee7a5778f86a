import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom import session
from tallyloom.operators import bands as bd
from tallyloom.operators import instalment as ins
from tallyloom.operators import waterfall as wf
from tallyloom.plans import catalog

DUE = [1500, 2500, 3000, 3500, 4000, 4500, 5000, 6000, 7000, 8000, 9000, 10000, 11000, 12000]


@pytest.fixture(scope="module")
def loan(spark):
    return spark.createDataFrame([(1, Decimal(100000), Decimal(8000), [Decimal(d) for d in DUE])],
                                 "id int, loan decimal(18,2), payment decimal(18,2), due array<decimal(18,2)>")


def years(loan, scenario):
    return {r.year: r for r in wf.waterfall(loan, scenario, ["id"]).collect()}


def test_old(loan):
    y = years(loan, "old")
    assert len(y) == 14
    assert {n: float(y[n].p_end) for n in (1, 9, 10, 11, 13, 14)} == {
        1: 93000.0, 9: 34420.3, 10: 26764.5, 11: 19033.87, 13: 3363.66, 14: -4567.98,
    }
    assert [float(y[n].penalty_accrued) for n in (10, 11, 12, 13, 14)] == [0, 1.72, 8.07, 19.06, 34.72]
    assert [float(y[n].p_due_unpaid) for n in (9, 10, 11, 12)] == [0, 344.2, 1613.57, 3811.98]
    assert float(y[11].cut_principal) == 7730.63 and float(y[14].total_due) == 12033.64
    assert [n for n in y if y[n].last_payment] == [14]


def test_interim(loan):
    y = years(loan, "interim")
    assert len(y) == 13
    assert {n: float(y[n].p_end) for n in (1, 12, 13)} == {1: 92000, 12: 4000, 13: 0}
    assert float(y[13].cut_principal) == 4000
    assert [float(y[n].interest_unpaid) for n in (1, 3, 8, 13)] == [1000, 2760, 5760, 6760]
    assert [n for n in y if y[n].last_payment] == [13]


def test_new(loan):
    y = years(loan, "new")
    assert len(y) == 14
    assert {n: float(y[n].p_end) for n in (1, 9, 10, 14)} == {1: 93000, 9: 34420.3, 10: 26420.3, 14: -5579.7}
    assert [float(y[n].cut_p_extra) for n in (1, 8, 9, 10)] == [5500, 1504.95, 580, 0]
    assert [float(y[n].cut_interest) for n in (9, 10)] == [420, 0]


def test_head_and_tail(loan):
    rows = wf.head_and_tail(wf.waterfall(loan, "old", ["id"])).collect()
    assert sorted(r.year for r in rows) == [1, 2, 3, 14]


def test_tasks_of_a_schedule_do_not_grow_with_the_file(spark, tmp_path, monkeypatch):
    """One file of orders is dealt to more tasks than the reader would make of it."""
    orders = spark.range(40_000).selectExpr("id o_orderkey", "cast(1000 + id % 977 as double) o_totalprice")
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    size = sum(f.stat().st_size for f in (tmp_path / "orders.parquet").glob("*.parquet"))
    monkeypatch.setattr(session, "TASK_INPUT", size // 40)
    sizes = catalog._loans(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 40 and max(r["count"] for r in sizes) < 2_000
    assert sum(r["count"] for r in sizes) == 40_000


def test_empty_due_list(spark):
    bare = spark.createDataFrame([(1, Decimal(5), Decimal(1), [])],
                                 "id int, loan decimal(18,2), payment decimal(18,2), due array<decimal(18,2)>")
    assert wf.waterfall(bare, "old", ["id"]).count() == 0


BANDS = [
    ("0", 0), ("1", 270), ("45000", 270), ("45000.01", 300), ("50000", 300), ("50001", 360), ("60000", 360),
    ("60001", 420), ("100000", 600), ("670000", 4020), ("1330000", 7970), ("1331000", 8020), ("1700000", 10180),
    ("1700001", None),
]


def amounts(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.col("t").cast("decimal(18,2)").alias("amount"))


def test_band_spot_values(spark):
    rows = amounts(spark, [t for t, _ in BANDS]).select("t", bd.instalment_payment(F.col("amount")).alias("pay"))
    assert {r.t: r.pay for r in rows.collect()} == dict(BANDS)


def test_band_join_equals_closed_form(spark):
    rng = random.Random(5)
    texts = {f"{rng.uniform(1, 1_750_000):.2f}" for _ in range(3000)} | {str(10_000 * k) for k in range(1, 176)}
    rows = amounts(spark, texts)
    joined = bd.band_join(rows, "amount", bd.instalment_bands(spark), "upper", ["pay"], 5_000, bd.TOP_AMOUNT)
    both = joined.withColumn("closed", bd.instalment_payment(F.col("amount")))
    assert both.count() == len(texts)
    assert both.where(~F.col("pay").eqNullSafe(F.col("closed"))).count() == 0
    assert bd.instalment_bands(spark).count() == 167


def months_by_loop(balance, interest):
    n = 0
    while balance > 0:
        balance, n = balance + ((1 / 100) / 12) * balance - 270, n + 1
    left = balance + interest
    while left > 0:
        left, n = left - 270, n + 1
    return n


def test_payoff_months(spark):
    rng = random.Random(3)
    cases = [(10000.0, 500.0), (45000.0, 0.0), (270.0, 0.0), (0.0, 500.0), (20000.0, 1200.5)]
    cases += [(round(rng.uniform(0, 45000), 2), round(rng.uniform(0, 5000), 2)) for _ in range(2000)]
    rows = spark.createDataFrame(cases, "b double, i double").select(
        "b", "i", ins.payoff_months(F.col("b"), F.col("i")).alias("n")
    ).collect()
    assert [r.n for r in rows[:5]] == [40, 180, 2, 2, 81]
    assert all(r.n == months_by_loop(r.b, r.i) for r in rows)


def test_never_paid_off_is_null(spark):
    got = spark.range(1).select(ins.payoff_months(F.lit(324000.0), F.lit(0.0)), ins.payoff_months(F.lit(323999.0), F.lit(0.0))).first()
    assert got[0] is None and got[1] > 1000


def plan_of(spark, **values):
    defaults = dict(id=1, amount=Decimal(45000), remaining=10000.0, interest=500.0, birth=dt.date(1994, 9, 23), as_of=dt.date(2024, 6, 15))
    defaults.update(values)
    df = spark.createDataFrame([tuple(defaults.values())], "id int, amount decimal(18,2), remaining double, interest double, birth_date date, as_of date")
    return ins.instalment_plan(df, ["id"]).first()


def test_plan_small_debt(spark):
    row = plan_of(spark)
    assert row.age_limit_text == "23/9/2602"
    assert row.first_payment == dt.date(2024, 7, 5) and row.first_payment_be == "05/7/2567"
    assert (row.age_limit_months, row.months, row.pay) == (180, 40, 270)
    last = dt.date(2024, 7, 5) + dt.timedelta(days=39 * 30)
    assert row.payoff_be == f"{last:%d/%m}/{last.year + 543}"


def test_plan_large_debt(spark):
    assert plan_of(spark, amount=Decimal(100000)).payoff_be == "05/05/2582"
    old = plan_of(spark, amount=Decimal(100000), birth=dt.date(1960, 9, 23))
    assert (old.age_limit_months, old.months, old.payoff_be) == (15, 0, "15/6/2567")
    assert plan_of(spark, amount=Decimal(1700001)).above_top_band


@pytest.mark.parametrize("birth, months", [
    (dt.date(1959, 7, 5), 1), (dt.date(1959, 7, 4), 0), (dt.date(1959, 8, 4), 1), (dt.date(1959, 8, 5), 2),
    (dt.date(1950, 1, 1), 0), (dt.date(1974, 6, 5), 180), (dt.date(1974, 6, 4), 179),
])
def test_months_to_age_limit(spark, birth, months):
    assert plan_of(spark, birth=birth).age_limit_months == months


def test_december_contract(spark):
    row = plan_of(spark, as_of=dt.date(2024, 12, 20), birth=dt.date(1960, 1, 5))
    assert row.first_payment == dt.date(2025, 1, 5) and row.age_limit_months == 1


def test_the_number_of_bands_is_known(spark):
    assert bd.instalment_bands(spark).count() == bd.INSTALMENT_BANDS

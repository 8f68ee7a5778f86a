import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions import labels as lb
from tallyloom.functions import parsing as ps


def apply(spark, build, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[1] for r in df.select("i", build("v").alias("o")).orderBy("i").collect()]


def check(spark, build, table):
    assert apply(spark, build, [k for k, _ in table]) == [v for _, v in table]


def test_number(spark):
    check(
        spark,
        ps.number,
        [
            ("1,234.50", 1234.5), (" 12 ", 12.0), ("\t 7 ", 7.0), ("-", 0.0), ("N/A", 0.0), ("", 0.0),
            (None, 0.0), ("nan", 0.0), ("NaN", 0.0), ("null", 0.0), ("None", 0.0), ("abc", 0.0), ("1d", 0.0),
            ("1f", 0.0), ("0x10", 0.0), ("-5", -5.0), ("+.5", 0.5), ("1e3", 1000.0), ("Infinity", 0.0),
        ],
    )


def test_whole_number_cuts(spark):
    check(spark, ps.whole_number, [("12.9", 12), ("-12.9", -12), ("x", 0), (None, 0)])


def test_unreadable_flag(spark):
    check(spark, ps.is_unreadable_number, [("1", False), ("x", True), (None, True), ("-", True)])


def test_ledger_date(spark):
    day = dt.date(2024, 7, 5)
    check(
        spark,
        ps.ledger_date,
        [
            ("2024-07-05 00:00:00", day), ("2024-7-5", day), ("05/07/2024", day), ("2024/07/05", day),
            ("2024-07-05 13:45:00", day), (" 2024-07-05 ", day), ("2024-13-05", None), ("-", None),
            ("2024-02-30", None), ("", None), (None, None), ("24-07-05", None), ("31/04/2024", None),
        ],
    )


def test_buddhist_date(spark):
    check(
        spark,
        ps.buddhist_date,
        [
            ("05/07/2567", dt.date(2024, 7, 5)), ("5/7/2567", dt.date(2024, 7, 5)), ("30/02/2567", None),
            ("29/02/2567", dt.date(2024, 2, 29)), ("29/02/2566", None), ("1/1/2400", None), ("5-7-2567", None),
            ("05/07", None), ("a/b/c", None), (None, None), ("05/07/2567/1", None), (" 5 / 7 / 2567 ", dt.date(2024, 7, 5)),
        ],
    )


def test_schedule_date(spark):
    check(
        spark,
        ps.schedule_date,
        [
            ("03/04/2024", dt.date(2024, 4, 3)), ("12/31/2024", dt.date(2024, 12, 31)),
            ("2024-07-05 00:00:00", dt.date(2024, 7, 5)), ("2024/07/05", dt.date(2024, 7, 5)),
            ("2336-01-01", dt.date(2336, 1, 1)), ("13/13/2024", None), ("-", None),
        ],
    )


def test_account_key(spark):
    check(
        spark,
        ps.account_key,
        [("  00012 ", "12"), ("000", ""), ("A01", "A01"), ("0A0", "A0"), (" 007　", "7"), (None, None)],
    )


def test_cells_and_iso(spark):
    check(spark, ps.cell, [("x", "x"), (" x ", " x "), ("", None), (" - ", None), ("NULL", None), ("N/A", None)])
    check(spark, lambda c: ps.iso_text(ps.ledger_date(c)), [("2024-7-5", "2024-07-05"), ("?", "")])


def test_active_flag(spark):
    check(spark, ps.is_active_group, [("1", True), ("01", True), ("0", False), ("1.0", False), (None, False), ("x", False)])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.dates(dt.date(1900, 1, 1), dt.date(2100, 12, 31)), min_size=1, max_size=40))
def test_calendars_round_trip(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    text = ps.buddhist_text("d")
    back = df.select("d", ps.buddhist_date(text).alias("b"), ps.ledger_date(F.col("d").cast("string")).alias("l"))
    assert all(r.d == r.b == r.l for r in back.collect())


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.,-+eEdf nN/A", max_size=8), min_size=1, max_size=60))
def test_number_agrees_with_plain_float(spark, texts):
    def plain(text):
        tidy = text.strip().replace(",", "")
        try:
            value = float(tidy)
        except ValueError:
            return 0.0
        return value if value == value and abs(value) != float("inf") else 0.0

    got = apply(spark, ps.number, texts)
    assert [g if abs(g) != float("inf") else 0.0 for g in got] == [plain(t) for t in texts]


def test_labels(spark):
    row = spark.range(1).select(
        lb.shorten(F.lit("abcdefgh"), 5).alias("a"),
        lb.shorten(F.lit("abc"), 5).alias("b"),
        lb.padded_id(F.lit(7)).alias("c"),
        lb.padded_id(F.lit(12345)).alias("d"),
        lb.money_text(F.lit(1234567.5)).alias("e"),
        lb.percent_of(F.lit(24.0), F.lit(30.0)).alias("f"),
        lb.shortfall(F.lit(0.64), F.lit(1.28)).alias("g"),
        lb.shortfall(F.lit(40), F.lit(30)).alias("h"),
        lb.relayout_date(F.lit(dt.date(2025, 6, 24))).alias("i"),
        lb.relayout_date(F.lit(dt.date(2025, 6, 24)), "MM/dd").alias("j"),
    ).first()
    assert tuple(row) == ("abcde...", "abc", "007", "12345", "1,234,567.50", 80, 0.64, 0, "24/06/2025", "06/24")


@pytest.mark.parametrize("count, band", [(0, "0"), (1, "1-20"), (20, "1-20"), (21, "21+"), (1225, "21+")])
def test_payment_count_bands(spark, count, band):
    assert spark.range(1).select(lb.payment_count_band(F.lit(count))).first()[0] == band

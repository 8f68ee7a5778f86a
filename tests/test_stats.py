import numpy as np
import pytest
from conftest import one
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.operators import summary as sm
from tallyloom.operators.quantiles import quantiles, value_counts
from tallyloom.operators.topn import top_rows

MARKS = {"low": 0.0, "q1": 0.25, "median": 0.5, "p95": 0.95, "p99": 0.99, "high": 1.0}


def as_compared(spark, gaps):
    df = spark.createDataFrame([(float(g),) for g in gaps], "bal_diff double")
    return df.select("*", F.lit(True).alias("matched"), F.lit("both").alias("mismatch"), F.lit(1).cast("bigint").alias("copies"))


@pytest.mark.parametrize("bins", [2, 16, 512])
@pytest.mark.parametrize("seed", range(3))
def test_quantiles_match_numpy(spark, bins, seed):
    rng = np.random.default_rng(seed)
    values = np.round(np.concatenate([rng.normal(0, 100, 500), np.full(400, 7.25), rng.integers(-3, 3, 100)]), 2)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = one(quantiles(value_counts(df, F.col("x")), MARKS, bins))
    for name, p in MARKS.items():
        assert got[name] == pytest.approx(np.percentile(values, p * 100), abs=1e-9)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6).map(lambda v: round(v, 2)), min_size=1, max_size=50))
def test_quantiles_of_short_lists(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = one(quantiles(value_counts(df, F.col("x")), {"m": 0.5, "p": 0.95}))
    assert got["m"] == pytest.approx(np.percentile(values, 50), abs=1e-6)
    assert got["p"] == pytest.approx(np.percentile(values, 95), abs=1e-6)


def test_weights_count_as_rows(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (10.0, 6)], "x double, w int")
    got = one(quantiles(value_counts(df, F.col("x"), F.col("w")), {"m": 0.5, "q": 0.3}))
    plain = [1.0] * 3 + [2.0] + [10.0] * 6
    assert got == {"m": np.percentile(plain, 50), "q": pytest.approx(np.percentile(plain, 30))}


@pytest.mark.parametrize("seed", range(3))
def test_histogram_matches_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    gaps = np.concatenate([rng.normal(50, 300, 400), [0.0] * 50, [1e6, -1e6]])
    rows = sm.error_histogram(as_compared(spark, gaps)).orderBy("bin").collect()
    limit = np.percentile(np.abs(gaps), 99)
    counts, edges = np.histogram(gaps[np.abs(gaps) < limit], bins=50)
    assert [r["rows"] for r in rows] == counts.tolist()
    assert [r.low_edge for r in rows] == pytest.approx(edges[:-1].tolist(), abs=1e-3)
    assert rows[-1].high_edge == pytest.approx(edges[-1], abs=1e-3)
    merged = sm.merged_bins(sm.error_histogram(as_compared(spark, gaps))).orderBy("bin").collect()
    assert [r.bin for r in merged] == list(range(1, 26))
    assert [r["rows"] for r in merged] == (counts[0::2] + counts[1::2]).tolist()


def test_histogram_of_one_value(spark):
    rows = sm.error_histogram(as_compared(spark, [5.0] * 10 + [900.0])).orderBy("bin").collect()
    counts, edges = np.histogram([5.0] * 10, bins=50)
    assert [r["rows"] for r in rows] == counts.tolist()
    assert rows[0].low_edge == edges[0] == 4.5


def test_histogram_is_empty_where_nothing_is_below_the_cut(spark):
    assert sm.error_histogram(as_compared(spark, [5.0, 5.0])).count() == 0


@pytest.mark.parametrize("n", [5, 2_500])
def test_top_rows(spark, n):
    df = spark.range(10_000).select((F.hash("id") % 1000).alias("a"), F.col("id").alias("b"))
    expected = sorted((r.a, r.b) for r in df.collect())[:n]
    assert [tuple(r) for r in top_rows(df, ["a", "b"], n).collect()] == expected

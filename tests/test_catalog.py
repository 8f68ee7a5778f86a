import contextlib
import io

import check
import pytest

import __spark_entry__ as entry_points
from tallyloom.plans.catalog import QUERIES
from tallyloom.plans.oracle import ORACLE as SQL

READS_FILE_BYTES = {"file_inventory", "row_estimate_sampled"}


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def con(folder):
    connection = check.connect(folder)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())
    assert not any(word in SQL[name].lower().split() for name in QUERIES for word in ("limit", "least(count(*),"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, folder, con, name):
    df = QUERIES[name](spark, folder)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert name in READS_FILE_BYTES or ("Python" not in plan and "InPandas" not in plan)
    assert check.differences(df, con, SQL[name]) == []


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1


def test_scans_read_only_what_they_need(spark, folder):
    plan = plan_of(QUERIES["deficit_by_resource"](spark, folder))
    assert "ReadSchema: struct<l_linenumber:int,l_quantity:double>" in plan.replace("l_quantity:double,l_linenumber:int", "l_linenumber:int,l_quantity:double")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan_of(
        QUERIES["filter_by_type"](spark, folder)
    )


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_three_way_shares_one_shuffle_per_ledger(spark, folder, no_broadcast):
    plan = plan_of(QUERIES["reconcile_three_way"](spark, folder)).split("\n\n")[0]
    assert plan.count("SortMergeJoin") == 2
    # Between the two joins there is neither an exchange nor a sort.
    first = plan.index("SortMergeJoin")
    between = plan[first : plan.index("SortMergeJoin", first + 1)]
    assert "Exchange" not in between and "Sort (" not in between


def test_waterfall_needs_no_shuffle(spark, folder):
    from tallyloom.operators.waterfall import waterfall
    from tallyloom.sources.derived import table
    from pyspark.sql import functions as F

    loans = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("loan"), F.lit(8000).alias("payment"), F.array(F.lit(10)).alias("due")
    )
    assert "Exchange" not in plan_of(waterfall(loans, "old", ["o_orderkey"]))


def test_lists_have_no_limit(spark, folder):
    for name in ("discrepancies_ab", "three_way_listing", "search_account", "scatter_cells"):
        assert "Limit" not in plan_of(QUERIES[name](spark, folder))


def test_digests_are_not_gathered_in_one_task(spark, tmp_path):
    from tallyloom.sources import files as fl

    for k in range(60):
        (tmp_path / f"f{k:02}.csv").write_bytes(b"x\n" * 200_000)
    df = fl.digests(spark, str(tmp_path))
    assert "Exchange" not in plan_of(df) and df.rdd.getNumPartitions() > 1

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from tallyloom.session import local_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "8", "tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return DATA


def one(df):
    """The single row of a frame as a dict."""
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


@pytest.fixture(scope="session")
def mini(spark):
    """The hand-computed ledgers: system, counterpart and schedule as raw text."""
    a = spark.createDataFrame(
        [
            ("0001", "1", "2024-07-05 00:00:00", "1000.00", "1000.00"),
            ("0002", "1", "2024-7-5", "2,000.00", "2500.00"),
            ("0003", "0", "2024-07-05", "10", "10"),
            ("0004", "1", "-", "0", "0"),
            ("0005", "1", "2024-07-05 00:00:00", "500", "500"),
        ],
        "acc_no string, group_flag string, first_payment_date string, pre_balance string, exact_pre_balance string",
    )
    b = spark.createDataFrame(
        [
            ("1", "05/07/2567", "1000.00", "part1.csv"),
            ("2", "06/07/2567", "2000.00", "part1.csv"),
            ("3", "05/07/2567", "10", "part1.csv"),
            ("4", "30/02/2567", "5", "part1.csv"),
            ("5", "05/07/2567", "500.50", "part1.csv"),
            ("5", "05/07/2567", "500.50", "part2.csv"),
            ("5", "06/07/2567", "500", "part2.csv"),
        ],
        "acc_no string, start_date_be string, loan_balance string, source_file string",
    )
    s = spark.createDataFrame(
        [
            ("0001", "2024-07-05", "1000.00"),
            ("0001", "05/08/2024", "900"),
            ("2", "2024/07/06", "2000"),
            ("0009", "2024-01-05", "1"),
        ],
        "acc_no string, due_payment_date string, capital_remain string",
    )
    return a, b, s

import hashlib
import json
import os

import pytest
from conftest import one
from pyspark.sql import functions as F

from tallyloom.plans.reconcile import Reconciliation
from tallyloom.sinks import outputs as out
from tallyloom.operators import dedup as dd
from tallyloom.sources import delimited as dl
from tallyloom.sources import rejects as rj
from tallyloom.sources import files as fl

HEADER_B = "เลขบัญชี,วันที่เริ่มชำระหนี้,ยอดหนี้เงินกู้"


def write(folder, name, text, encoding="utf-8"):
    with open(os.path.join(folder, name), "wb") as f:
        f.write(text.encode(encoding))


@pytest.fixture
def place(tmp_path):
    return str(tmp_path)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_inventory(spark, place):
    for name in ("b.csv", "a.TXT", "c.CSV", "d.dat", "e.txt"):
        write(place, name, "x\n")
    os.mkdir(os.path.join(place, "below"))
    write(os.path.join(place, "below"), "f.csv", "x\n")
    assert sorted(r.name for r in fl.inventory(spark, place).collect()) == ["a.TXT", "b.csv", "c.CSV", "e.txt"]


def test_profile_and_totals(spark, place):
    write(place, "a.csv", "ACC_NO,X\n" + "1234567,89\n" * 100)
    write(place, "b.csv", "title\n\nACC_NO,X\n1,2\n")
    found = {r.name: r for r in fl.profile(spark, place, ["ACC_NO"]).collect()}
    assert (found["a.csv"].leading_rows, found["a.csv"].lines, found["a.csv"].header) == (1, 101, ["ACC_NO", "X"])
    assert (found["b.csv"].leading_rows, found["b.csv"].header) == (2, ["ACC_NO", "X"])
    write(place, "c.csv", "no line end")
    for counted in (fl.profile(spark, place), fl.line_counts(spark, place)):
        totals = one(fl.folder_totals(counted))
        assert (totals["files"], totals["lines"]) == (3, 106)


def test_guess_encoding():
    thai = "เลขบัญชี,1\n"

    def guess(data):
        try:
            data.decode("utf-8")
            sound = True
        except UnicodeDecodeError:
            sound = False
        return fl.guess_encoding(data[:8], sound, set(data))

    assert guess(b"\xef\xbb\xbfx") == "utf-8-sig"
    assert guess(thai.encode("utf-16")) == "utf-16"
    assert guess(thai.encode("utf-8")) == "utf-8"
    assert guess(b"plain\n") == "utf-8"
    assert guess(thai.encode("iso-8859-11")) == "iso-8859-11"
    assert guess((thai + "“€”").encode("cp874")) == "cp874"
    assert guess(b"caf\xff\n") == "latin-1"


def test_encoding_is_that_of_all_bytes(spark, place):
    head = HEADER_B.encode("ascii", "ignore") + b"ACC_NO,DUE_PAYMENT_DATE,CAPITAL_REMAIN\n"
    with open(os.path.join(place, "a.csv"), "wb") as f:
        f.write(head[head.index(b"ACC_NO") :] + b"1,2024-07-05,10\n" * 120_000 + "ก“9,2024-07-05,10\n".encode("cp874"))
    got = dl.load_schedule(spark, place).where("acc_no != '1'")
    assert rows(got, "acc_no") == [("ก“9",)]


def test_leading_rows_go_by_position(spark, place):
    text = "7,2024-01-01,5\n\nACC_NO,DUE_PAYMENT_DATE,CAPITAL_REMAIN\n7,2024-01-01,5\n8,2024-01-02,6\n7,2024-01-01,5\n"
    write(place, "a.csv", text)
    write(place, "b.csv", "t\n" * 30 + text[text.index("ACC") :])
    want = [("7", "5")] * 4 + [("8", "6")] * 2
    assert rows(dl.load_schedule(spark, place), "acc_no", "capital_remain") == want
    assert dl.rejected_lines(spark, place, dl.SCHEDULE).count() == 0


@pytest.mark.parametrize("title", ["", "title\n"])
def test_line_breaks_inside_quotes(spark, place, title):
    write(place, "a.csv", title + 'ACC_NO,DUE_PAYMENT_DATE,CAPITAL_REMAIN\n"x\ny",2024-07-05,10\n2,2024-07-05,20\n')
    write(place, "b.csv", 'ACC_NO,DUE_PAYMENT_DATE,CAPITAL_REMAIN\n"3",2024-07-05,"3,0"\n')
    assert rows(dl.load_schedule(spark, place), "acc_no", "capital_remain") == [("2", "20"), ("3", "3,0"), ("x\ny", "10")]
    assert dl.rejected_lines(spark, place, dl.SCHEDULE).count() == 0


def test_skipped_and_unreadable_files(spark, place):
    write(place, "a.csv", "ACC_NO,DUE_PAYMENT_DATE,CAPITAL_REMAIN\n1,2024-07-05,10\n")
    write(place, "b.csv", "something,else\n1,2\n")
    assert rows(dl.skipped_files(spark, place, dl.SCHEDULE), "name", "reason") == [("b.csv", "no column ACC_NO")]
    with pytest.raises(OSError):
        fl._profile(os.path.join(place, "gone.csv"), 1, [])


def test_titles_of_one_length_share_a_scan(spark, place):
    for k in range(12):
        write(place, f"{k}.csv", f"report {k}\nACC_NO,DUE_PAYMENT_DATE,CAPITAL_REMAIN\n{k},2024-07-05,10\n")
    got = dl.load_schedule(spark, place)
    assert got.count() == 12
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan csv") <= 2


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "utf-16", "iso-8859-11", "cp874"])
def test_code_pages(spark, place, encoding):
    write(place, "part.csv", HEADER_B + "\n0001,05/07/2567,\"1,000.50\"\n2,-,N/A\n", encoding)
    got = rows(dl.load_counterpart(spark, place), "acc_no", "start_date_be", "loan_balance", "source_file")
    assert got == [("0001", "05/07/2567", "1,000.50", "part.csv"), ("2", None, None, "part.csv")]


def test_mixed_files_are_united(spark, place):
    write(place, "a.csv", HEADER_B + "\n1,05/07/2567,10\n", "cp874")
    write(place, "b.csv", "report of the month\n\nลำดับ," + HEADER_B + "\n1,2,06/07/2567,20\n")
    write(place, "c.csv", "ยอดหนี้เงินกู้ (บาท),เลขบัญชีเงินกู้\n30,3\n")
    write(place, "d.csv", "something,else\n1,2\n")
    got = rows(dl.load_counterpart(spark, place), "acc_no", "start_date_be", "loan_balance", "source_file")
    assert got == [
        ("1", "05/07/2567", "10", "a.csv"), ("2", "06/07/2567", "20", "b.csv"), ("3", None, "30", "c.csv"),
    ]


@pytest.mark.parametrize("name", ["two words.csv", "50%+1.csv", "ไทย.csv", "a%20b.csv"])
def test_odd_file_names(spark, place, name):
    write(place, name, HEADER_B + "\n1,05/07/2567,10\n")
    assert rows(dl.load_counterpart(spark, place), "acc_no", "source_file") == [("1", name)]


def test_bad_lines(spark, place):
    write(place, "a.csv", "ACC_NO,DUE_PAYMENT_DATE,CAPITAL_REMAIN\n1,2024-07-05,10\n2,2024-07-05,20,oops\n3,2024-07-05\n")
    assert rows(dl.load_schedule(spark, place), "acc_no", "capital_remain") == [("1", "10"), ("3", None)]
    bad = one(dl.rejected_lines(spark, place, dl.SCHEDULE))
    assert (bad["acc_no"], bad["beyond_header"], bad["source_file"]) == ("2", "oops", "a.csv")


def test_system_needs_its_account_column(spark, place):
    write(place, "a.csv", "ACC_NO,PRE_BALANCE,OTHER,FIRST_PAYMENT_DATE\n007,1,x,2024-07-05\n")
    write(place, "b.csv", "MY_ACC_NO,PRE_BALANCE\n8,1\n")
    got = dl.load_system(spark, place)
    assert set(got.columns) == {"acc_no", "pre_balance", "first_payment_date"}
    assert rows(got, "acc_no") == [("007",)]
    with pytest.raises(FileNotFoundError):
        dl.load_counterpart(spark, place)


def test_only_needed_columns_are_read(spark, place):
    write(place, "a.csv", "ACC_NO,DUE_PAYMENT_DATE,CAPITAL_REMAIN,MORE\n1,2024-07-05,10,x\n")
    plan = dl.load_schedule(spark, place).select("acc_no")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c0:string,_beyond_header:string>" in plan


def test_digests(spark, place):
    blob = b"abc" * 700_000
    with open(os.path.join(place, "a.csv"), "wb") as f:
        f.write(blob)
    row = one(fl.digests(spark, place))
    assert row == {"name": "a.csv", "bytes": len(blob), "sha256_16": hashlib.sha256(blob).hexdigest()[:16]}


@pytest.fixture
def extracts(spark, mini, tmp_path):
    folders = {}
    for name, df, layout in zip(("system", "counterpart", "schedule"), mini, (dl.SYSTEM, dl.COUNTERPART, dl.SCHEDULE)):
        folders[name] = str(tmp_path / name)
        heads = {alias: head for head, alias in layout.columns.items()}
        out.write_csv(df.select(*[F.col(a).alias(h) for a, h in heads.items()]), folders[name])
    return folders


def test_whole_run(spark, extracts, tmp_path):
    target = str(tmp_path / "results")
    matrix = {r.metric: (r.a_vs_b, r.s_vs_b, r.three_way) for r in out.run(spark, extracts, target, with_report=True).collect()}
    assert matrix["matched_rows"] == (5, 3, 3) and matrix["perfect"] == (1, 2, 1)
    assert sorted(os.listdir(target)) == [
        "conflicts", "debt_separation", "errors_ab", "errors_sb", "manifest", "manifest_files", "report", "scatter",
        "three_way_discrepancies", "three_way_perfect",
    ]
    errors = spark.read.option("header", True).csv(os.path.join(target, "errors_ab"))
    assert errors.columns[0] == "acc_no" and errors.count() == 4
    first = next(f for f in os.listdir(os.path.join(target, "errors_ab")) if f.endswith(".csv"))
    with open(os.path.join(target, "errors_ab", first), "rb") as f:
        assert f.read(3) == b"\xef\xbb\xbf"
    manifest = json.loads(spark.read.text(os.path.join(target, "manifest")).first()[0])
    assert manifest["statistics"]["ab"]["matched_rows"] == 5
    assert manifest["throughput"]["rows"] == 5 + 7 + 4 and manifest["throughput"]["rows_per_second"] > 0
    files = spark.read.json(os.path.join(target, "manifest_files")).collect()
    assert {f.ledger for f in files} == {"system", "counterpart", "schedule"}
    assert all(len(f.sha256_16) == 16 for f in files)
    report = json.loads(spark.read.text(os.path.join(target, "report")).first()[0])
    assert report["list_rows"]["errors_ab"] == 4 and report["charts"]["quality"]["integrity"] == 25.0
    assert report["charts"]["balance_errors_ab"]["p95"] == 4.325


def test_dry_run_writes_nothing(spark, extracts, tmp_path):
    target = str(tmp_path / "results")
    two = {k: v for k, v in extracts.items() if k != "schedule"}
    rows = {r.metric: r.a_vs_b for r in out.run(spark, two, target, dry_run=True).collect()}
    assert rows["matched_rows"] == 5 and not os.path.exists(target)


def test_payload_round_trip(spark, mini):
    payload = out.report_payload(Reconciliation(*mini))
    row = out.read_payload(payload, "version string, stats struct<ab: struct<matched_rows: bigint>>").first()
    assert row.stats.ab.matched_rows == 5


def test_lists_are_whole(spark, tmp_path):
    """More errors than any capture limit of a single machine."""
    keys = spark.range(120_000).select(F.col("id").cast("string").alias("acc_no"))
    a = keys.select("acc_no", F.lit("2024-07-05").alias("first_payment_date"), F.lit("10").alias("pre_balance"))
    b = keys.select("acc_no", F.lit("05/07/2567").alias("start_date_be"), F.lit("11").alias("loan_balance"), F.lit("p").alias("source_file"))
    written = out.write_lists(Reconciliation(a, b), str(tmp_path / "lists"))
    assert spark.read.option("header", True).csv(written["errors_ab"]).count() == 120_000


def test_failed_run_leaves_the_last_results(spark, tmp_path):
    target = str(tmp_path / "lists")
    staged = out.Staged(spark, target)
    spark.range(3).write.json(staged.path("one"))
    assert staged.publish() == {"one": f"{target}/one"}
    again = out.Staged(spark, target)
    spark.range(5).write.json(again.path("one"))  # never published
    assert spark.read.json(f"{target}/one").count() == 3


def test_header_behind_any_preamble(spark, tmp_path):
    """Three megabytes of titles, and blocks smaller than that."""
    lines = [f"title {k}, of a report without end" for k in range(90_000)]
    rows = [f"{k},2024-01-01,{k}" for k in range(5_000)]
    (tmp_path / "a.csv").write_text("\n".join(lines + ["", ",".join(dl.SCHEDULE.columns)] + rows) + "\n")
    (tmp_path / "b.csv").write_text(",".join(dl.SCHEDULE.columns) + "\n7000,x,1\n")
    (tmp_path / "c.csv").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("128m", "500k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = dl.read_extract(spark, str(tmp_path), dl.SCHEDULE)
            ids = sorted(int(r.acc_no) for r in found.collect())
            strict = rj.read_strict(spark, str(tmp_path), dl.SCHEDULE).count()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert ids == [*range(5_000), 7_000] and strict == 5_001
    assert [r.name for r in dl.skipped_files(spark, str(tmp_path), dl.SCHEDULE).collect()] == ["c.csv"]


def test_first_row_in_file_order_whatever_the_splits(spark, tmp_path):
    head = "เลขบัญชี,วันที่เริ่มชำระหนี้,ยอดหนี้เงินกู้,note\n"
    for name, shift in (("b.csv", 0), ("a.csv", 500)):
        rows = "".join(f"{(k * 7 + shift) % 3000},05/07/2567,{k % 3}.00,{'x' * (k % 50)}\n" for k in range(12_000))
        (tmp_path / name).write_text(head + rows, encoding="utf-8")
    seen = {}
    for name, shift in (("a.csv", 500), ("b.csv", 0)):
        for k in range(12_000):
            key = (str((k * 7 + shift) % 3000), float(k % 3))
            seen.setdefault(key, [name, 0])[1] += 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    places = []
    for size in ("128m", "40k", "7k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            typed = dd.typed_counterpart(dl.read_extract(spark, str(tmp_path), dl.COUNTERPART, with_place=True))
            found = dd.first_rows(typed, ("source_file", "place")).collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert {(r.acc_no, r.loan_balance): [r.source_file, r.copies] for r in found} == seen
        rank = {(r.acc_no, r.loan_balance): n for n, r in enumerate(sorted(found, key=lambda r: (r.source_file, r.place.block, r.place.row)))}
        places.append(rank)
    assert places[0] == places[1] == places[2]

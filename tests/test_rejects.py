"""Strict reading: every line is kept or rejected for a reason."""

import numpy as np
import pytest

from tallyloom.sources import delimited as dl
from tallyloom.sources import rejects as rj
from tallyloom.sources.files import QuotedBreaks, Utf8Lines, profile

HEAD = "ACC_NO,DUE_PAYMENT_DATE,CAPITAL_REMAIN\n"


@pytest.fixture
def put(tmp_path):
    def write(name, content):
        (tmp_path / name).write_bytes(content if isinstance(content, bytes) else content.encode())
        return str(tmp_path)

    return write


def by_reason(spark, folder):
    return {(r.source_file, r.reason): r["rows"] for r in rj.rejects_by_reason(spark, folder, dl.SCHEDULE).collect()}


def test_each_fault_has_its_reason(spark, put):
    body = b'1,2024-01-01,5\n2,2024-01-01\n3,a,b,c\n4,"open,5\n5,\xff,5\n\n6,"a ""quoted"", cell",7\n7,,\n8,x,\n'
    folder = put("a.csv", b"\xef\xbb\xbf" + HEAD.encode() + body)
    assert by_reason(spark, folder) == {
        ("a.csv", "kept"): 4, ("a.csv", "short_line"): 1, ("a.csv", "long_line"): 1, ("a.csv", "open_quote"): 1, ("a.csv", "undecodable"): 1
    }
    kept = {r.acc_no: (r.due_payment_date, r.capital_remain) for r in rj.read_strict(spark, folder, dl.SCHEDULE).collect()}
    assert kept == {"1": ("2024-01-01", "5"), "6": ('a "quoted", cell', "7"), "7": (None, None), "8": ("x", None)}
    lines = {r.reason: r.line for r in rj.rejects(spark, folder, dl.SCHEDULE).collect()}
    assert lines["short_line"] == "2,2024-01-01" and lines["long_line"] == "3,a,b,c" and lines["open_quote"] == '4,"open,5'


def test_an_open_quote_costs_its_line_only(spark, put):
    rows = "".join(f"{k},2024-01-01,{k}\n" for k in range(200))
    folder = put("a.csv", HEAD + '900,"2024-01-01,5\n' + rows)
    assert by_reason(spark, folder) == {("a.csv", "kept"): 200, ("a.csv", "open_quote"): 1}
    # The tolerant reader gets those rows too.
    assert dl.read_extract(spark, folder, dl.SCHEDULE).filter("acc_no != '900'").count() == 200


def test_quoted_breaks_are_told_from_open_quotes_across_chunks():
    def held(data, size):
        breaks = QuotedBreaks()
        for k in range(0, len(data), size):
            codes = np.frombuffer(data[k : k + size], dtype=np.uint8)
            breaks.feed(codes, np.flatnonzero(codes == 10))
        return breaks.hold()

    for size in (1, 2, 3, 7, 100):
        assert held(b'a,"b\nc",d\n1,"x ""y""\nz"\r\n2,"q\n"\n', size)
        assert not held(b'a,b\n1,2\n', size) and not held(b'a,"b,c"\n1,"2"\n', size)
    for size in (7, 100):
        assert not held(b'1,"open\n2,b\n3,"open\n4,c\n', size) and not held(b'1,"open\n2,b\n', size)


def test_an_even_number_of_open_quotes(spark, put):
    folder = put("a.csv", HEAD + "".join(f'{k},{chr(34) * (k % 5 == 0)}2024-01-01,{k}\n' for k in range(100)))
    assert by_reason(spark, folder) == {("a.csv", "kept"): 80, ("a.csv", "open_quote"): 20}


def test_breaks_inside_quotes_make_records(spark, put):
    folder = put("a.csv", HEAD + '1,"two\nlines",5\n2,x\n3,a,b,c\n4,a,b,c,d\n5,"q ""r""\nmore",6\n')
    assert by_reason(spark, folder) == {("a.csv", "kept"): 2, ("a.csv", "short_line"): 1, ("a.csv", "long_line"): 2}
    kept = {r.acc_no: r.due_payment_date for r in rj.read_strict(spark, folder, dl.SCHEDULE).collect()}
    assert kept == {"1": "two\nlines", "5": 'q "r"\nmore'}


def test_late_headers_and_code_pages(spark, tmp_path):
    head = "เลขบัญชี,วันที่เริ่มชำระหนี้,ยอดหนี้เงินกู้\n"
    (tmp_path / "late.csv").write_bytes(("title\n\n" + head + "1,05/07/2567,5\n2,x\n").encode())
    (tmp_path / "page.csv").write_bytes((head + "3,ก,5\n4,ข,6,7\n").encode("cp874"))
    (tmp_path / "other.csv").write_text("a,b\n1,2\n")
    found = {(r.source_file, r.reason): r["rows"] for r in rj.rejects_by_reason(spark, str(tmp_path), dl.COUNTERPART).collect()}
    assert found == {("late.csv", "kept"): 1, ("late.csv", "short_line"): 1, ("page.csv", "kept"): 1, ("page.csv", "long_line"): 1}
    kept = {r.acc_no: r.start_date_be for r in rj.read_strict(spark, str(tmp_path), dl.COUNTERPART).collect()}
    assert kept == {"1": "05/07/2567", "3": "ก"}


def test_few_broken_bytes_do_not_turn_a_file_into_a_code_page(spark, put):
    head = "เลขบัญชี,วันที่เริ่มชำระหนี้,ยอดหนี้เงินกู้\n"
    body = b"".join(f"{k},ปี,5\n".encode() for k in range(50)) + b"77,\xe0\xb8,5\n"
    folder = put("b.csv", head.encode() + body)
    assert profile(spark, folder, list(dl.COUNTERPART.columns)).first().encoding == "utf-8"
    found = {r.reason: r["rows"] for r in rj.rejects_by_reason(spark, folder, dl.COUNTERPART).collect()}
    assert found == {"kept": 50, "undecodable": 1}


def test_utf8_is_judged_across_chunks():
    data = "กข,ค\n".encode() * 3 + b"\xff\n"
    for size in (1, 2, 5, 100):
        lines = Utf8Lines()
        for k in range(0, len(data), size):
            lines.feed(data[k : k + size])
        assert lines.hold() and (lines.wide, lines.bad) == (4, 1)
    mark = Utf8Lines()
    mark.feed(b"\xef\xbb\xbfa\n")
    assert mark.hold()
    thai = Utf8Lines()
    thai.feed("ก,ข\nค,ง\n".encode("cp874"))
    assert not thai.hold()
    assert Utf8Lines().hold()


def test_strict_reading_needs_a_usable_file(spark, put):
    with pytest.raises(FileNotFoundError):
        rj.read_strict(spark, put("a.csv", "x,y\n1,2\n"), dl.SCHEDULE)

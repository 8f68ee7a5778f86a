import gzip
import hashlib

import pytest

from tallyloom.llm import warc
from tallyloom.llm.common import work_folder

BIG = "<p>" + "x\r\n\r\nWARC/1.1\r\n" * 100 + "ü</p>"


def pages(spark):
    rows = [
        (1, "http://a/1", BIG, "z"), (2, "http://a/2", BIG, "z"), (9, "http://a/\r\nX-Bad: 1", BIG, None), (3, None, "small", "z"),
        (4, "http://a/4", "small", "z"), (5, "http://a/5", None, "z"), (6, "http://a/6", "", "z"), (None, "http://a/n", BIG, "z"),
        (7, "http://a/7", "y" * 999, "z"), (8, "http://a/8", "y" * 999, "z"), (10, "u", "y" * 1000, "z"), (11, "u", "y" * 1000, "z"),
        (11, "u", "y" * 1000, "z"), (12, "http://a/12", BIG + " ", "z"), (13, None, BIG * 400, "z"), (14, None, BIG * 400, "z"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")


def test_round_trip(spark):
    folder = warc.write_archives(warc.records_of(pages(spark)), work_folder(spark, "warc-test"))
    got = sorted(((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(spark, folder).collect()), key=repr)
    want = []
    rows = [(r.page_id, (r.html or "").encode()) for r in pages(spark).collect()]
    for key, data in rows:
        same = [k for k, d in rows if d == data and k is not None]
        original = max(same, default=None) if len(data) >= 1000 else None
        again = original is not None and key != original
        want.append((key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", original if again else None))
    assert got == sorted(want, key=repr)


def test_files_are_records_one_after_another(spark, tmp_path):
    folder = warc.write_archives(warc.records_of(pages(spark)), str(tmp_path / "w"))
    seen = []
    for path in (tmp_path / "w").glob("part-*"):
        data = path.read_bytes()
        for headers, block in warc.parse_archive(data):
            assert "x-bad" not in headers
            seen.append(headers)
            head, _, payload = block.partition(b"\r\n\r\n")
            assert head.startswith(b"HTTP/1.1 200")
            if headers["warc-type"] == "revisit":
                assert payload == b"" and headers["warc-profile"] == warc.PROFILE and "warc-refers-to" in headers
            else:
                assert "sha1:" + hashlib.sha1(payload).hexdigest() == headers["warc-payload-digest"]
        assert gzip.decompress(data).endswith(b"\r\n\r\n")
    assert len(seen) == 16 and sum(h["warc-type"] == "revisit" for h in seen) == 5


def test_given_revisits_are_resolved(spark):
    records = warc.records_of(pages(spark).filter("page_id in (1, 3)"))
    digest = hashlib.sha1(BIG.encode()).hexdigest()
    given = spark.createDataFrame(
        [(50, "u", "", digest, 0, "revisit"), (51, "u", "", "0" * 40, 0, "revisit")],
        "id long, uri string, payload string, payload_digest string, payload_bytes long, given_type string",
    )
    folder = warc.write_archives(records.unionByName(given), work_folder(spark, "warc-test"))
    rows = {r.id: (r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_archives(spark, folder).collect()}
    size = len(BIG.encode())
    assert rows == {1: ("response", None, size), 3: ("response", None, 5), 50: ("revisit", 1, size), 51: ("revisit", None, None)}


def test_empty_and_damaged(spark):
    folder = warc.write_archives(warc.records_of(pages(spark).limit(0)), work_folder(spark, "warc-test"))
    assert warc.read_archives(spark, folder).collect() == []
    with pytest.raises(ValueError):
        list(warc.parse_archive(b"HTTP/1.1 200 OK\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.parse_archive(b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc"))

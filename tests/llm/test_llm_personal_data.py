import hashlib
import os
import random
import re
import sys
import time

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_tables import no_documents, odd_documents
from tallyloom.llm import personal_data as pd13
from tallyloom.llm.queries import QUERIES, personal_data_digest

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn_by_hand(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (2 if k % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_by_hand(text):
    """The patterns as they are stated, tried from the left."""
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            keep = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and luhn_by_hand(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if keep:
                found.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def base_of(text):
    return [s[:3] for s in pd13.spans_of(text) if s[4]]


def card(rng, n):
    body = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(body + d for d in "0123456789" if luhn_by_hand(body + d))


def test_base_spans_against_the_stated_patterns():
    rng = random.Random(13)
    pieces = ["@", "a", "x.y", "b-c", ".", "..", "+", "-", " ", "  ", "(", ")", "1", "12", "255", "256", "007", "é", "🎉", "\n", "%", "_", "٠", "²"]
    kept = 0
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 40)))
        if rng.random() < 0.4:
            digits = card(rng, rng.randint(11, 20))
            split = "".join(d + rng.choice(["", "", " ", "-"]) for d in digits)
            text += rng.choice(["", " ", "x", "."]) + split + rng.choice(["", " ", "y", ".", "5"])
        if rng.random() < 0.3:
            text += "+" + "".join(rng.choice("0123456789 ()-.") for _ in range(rng.randint(5, 22)))
        assert base_of(text) == base_by_hand(text), repr(text)
        kept += len(base_of(text))
    assert kept > 2000


def test_checksums():
    assert pd13.luhn("4111111111111111") and not pd13.luhn("4111111111111112")
    assert pd13.mod97("DE89370400440532013000") and not pd13.mod97("DE88370400440532013000")
    assert pd13.mod97("GB82WEST12345698765432")


@pytest.mark.parametrize(
    "text,kind",
    [
        ("Bitte an DE89 3704 0044 0532 0130 00 zahlen", "iban"),
        ("pay GB82WEST12345698765432 NOW PLEASE", "iban"),
        ("pay GB82 WEST 1234 5698 7654 32 AND GO", "iban"),
        ("my social security number is 123-45-6789.", "ssn"),
        ("Telefon 030 1234567, abends", "local_phone"),
    ],
)
def test_further_spans_need_a_checksum_or_a_word(text, kind):
    (span,) = pd13.spans_of(text)
    assert span[0] == kind and not span[4] and span[3] >= pd13.LEAST_SCORE


@pytest.mark.parametrize(
    "text",
    ["DE88 3704 0044 0532 0130 00", "123-45-6789", "ssn 000-45-6789", "030 1234567", "order 030 1234567, phone", "xDE89370400440532013000", "token da6a7d4f67f2203943"],
)
def test_unconfirmed_further_spans_are_dropped(text):
    assert [s for s in pd13.spans_of(text) if not s[4]] == []


def test_context_moves_the_score():
    bare, card_word, version = (pd13.spans_of(f"{w} 10.20.30.40")[0][3] for w in ("so", "server", "version"))
    assert version < bare < card_word
    assert pd13.spans_of("call +49 30 1234567 on")[0][3] > pd13.spans_of("add +49 30 1234567 on")[0][3]


@pytest.mark.parametrize(
    "text",
    ["1" * 400_000, "1 " * 200_000, "1." * 200_000, "a" * 400_000, "a@" * 200_000, "+1(" * 150_000, "+" * 400_000, "A1" * 200_000, "AB12" * 100_000, "1-" * 200_000, "x@y." * 100_000, "10.0.0.1 " * 40_000],
    ids=lambda t: t[:8],
)
def test_long_texts_take_linear_time(text):
    begun = time.process_time()
    pd13.spans_of(text)
    assert time.process_time() - begun < 8


def test_query_digests(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op13_personal_data"](spark, folder).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    total = 0
    for r in rows:
        base = base_by_hand(texts[r.doc_id])
        joined = ",".join(f"{kind}:{start}:{end}" for kind, start, end in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[0] == kind for b in base) for kind in PATTERNS]
        assert [s for s in r.spans.split(",") if s.split(":")[0] in PATTERNS] == [s for s in joined.split(",") if s]
        total += len(base)
    assert total > 5


def test_odd_and_empty_tables(spark):
    docs = odd_documents(spark)
    rows = personal_data_digest(docs).collect()
    assert len(rows) == docs.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == empty and r.spans == "" for r in rows if r.doc_id in (3, 4, 5))
    assert personal_data_digest(no_documents(spark)).collect() == []
    whole = pd13.find_personal_data(docs)
    assert whole.columns == [*docs.columns, "found"]


def test_masked(spark):
    rows = [("mail a.b@c.de or 10.0.0.1 now",), (None,), ("",), ("card 4111 1111 1111 1111",)]
    out = spark.createDataFrame(rows, "text string").select(pd13.masked(F.col("text")).alias("m")).collect()
    assert [r.m for r in out] == ["mail [email] or [ip] now", None, "", "card [card]"]

"""Personal data in texts: proposed by patterns, confirmed by checksums, weighed by context.

A pattern proposes a span, a validator confirms or drops it (Luhn for card numbers, the
remainder modulo 97 for bank accounts, ranges for addresses and social security numbers), and
words beside it move its score. Two sorts of spans come out:

* base spans (e-mail, IP address, card, international phone): every confirmed proposal stays,
  whatever its score;
* further spans (bank account, social security number, phone without a country code): they
  stay at ``LEAST_SCORE`` or more and where no base span overlaps them, so that a bare
  group of digits needs a word that says what it is.

Proposals of a kind are leftmost, longest and do not overlap; a proposal that its validator
drops is not tried again in part. Every search is linear in the text: e-mails are sought from
their ``@``, numbers inside islands of digits and their separators.

Defined cases: a null or empty text holds nothing; offsets count code points, the end is
exclusive; texts of any length are read whole; repeated rows each get their spans; an empty
table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "ssn", "local_phone")
KINDS = BASE_KINDS + MORE_KINDS
LEAST_SCORE = 0.5
#: Code points before and after a span in which context words are looked for.
BEFORE, AFTER = 40, 20
#: What a word beside a span adds to its score, for it and against it.
FOR, AGAINST = 0.35, -0.3
SPANS = "array<struct<kind: string, start: long, end: long, score: double, base: boolean>>"

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ISLAND = re.compile(r"[0-9][0-9. -]*+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9.-])[0-9](?:[ .-]?[0-9]){6,11}(?![0-9])")
WORD = re.compile(r"[^\W\d_]+")

#: Score of a confirmed span before its context is read.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.35, "local_phone": 0.2}
#: Words that speak for a kind, in the languages of the corpus.
WORDS_FOR = {
    "email": {"email", "mail", "contact", "kontakt", "correo", "courriel", "write"},
    "ip": {"ip", "host", "server", "address", "adresse", "client", "login", "dirección"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "karte", "kreditkarte", "carte", "tarjeta"},
    "phone": {"phone", "tel", "telephone", "mobile", "call", "fax", "telefon", "mobil", "téléphone", "teléfono", "móvil"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta", "bic"},
    "ssn": {"ssn", "social", "security"},
    "local_phone": {"phone", "tel", "telephone", "mobile", "call", "fax", "telefon", "mobil", "téléphone", "teléfono", "móvil"},
}
#: Words that speak against any kind made of digits.
WORDS_AGAINST = {"version", "release", "order", "invoice", "isbn", "issn", "doi", "build", "serial", "page", "rechnung", "facture", "pedido"}


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Check digits of a bank account: letters count 10 to 35, the first four signs go last."""
    turned = account[4:] + account[:4]
    return int("".join(str(int(sign, 36)) for sign in turned)) % 97 == 1


def digits_of(text: str) -> str:
    return "".join(filter(str.isdigit, text))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def emails(text: str) -> Iterator[tuple[str, int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        before = text[free:at]
        local = len(before) - len(before.rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if local else None
        if found:
            yield "email", at - local, found.end()
        # The local part has no sign of this kind, so the next one begins behind it at least.
        free = found.end() if found else at + 1
        at = text.find("@", free)


def numbers(text: str) -> Iterator[tuple[str, int, int]]:
    """IP addresses and cards, both made of digits with dots, or with blanks and hyphens, between."""
    for island in ISLAND.finditer(text):
        start, end = island.span()
        if end - start < 7:  # an address has seven signs at least, a card twelve
            continue
        for m in IP.finditer(text, start, end):
            if all(map(_small, m.group().split("."))):
                yield "ip", *m.span()
        for m in CARD.finditer(text, start, end):
            digits = digits_of(m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield "card", *m.span()


def phones(text: str) -> Iterator[tuple[str, int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= len(digits_of(m.group())) <= 15:
            yield "phone", *m.span()


def further(text: str) -> Iterator[tuple[str, int, int]]:
    for m in IBAN.finditer(text):
        start, span = m.start(), m.group()
        # A following word in capitals may have been taken along: give up whole groups from the end.
        while len(account := span.replace(" ", "")) >= 15 and not text[start - 1 : start].isalnum():
            end = start + len(span)
            if mod97(account) and not text[end : end + 1].isalnum():
                yield "iban", start, end
                break
            span = span.rpartition(" ")[0]
    if "-" in text:
        for m in SSN.finditer(text):
            area, group, serial = m.groups()
            if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
                yield "ssn", *m.span()
    for island in ISLAND.finditer(text):
        if island.end() - island.start() >= 7:
            for m in LOCAL_PHONE.finditer(text, *island.span()):
                yield "local_phone", *m.span()


def score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's score, moved by the words beside the span."""
    near = {w.lower() for w in WORD.findall(text[max(0, start - BEFORE) : start])}
    near |= {w.lower() for w in WORD.findall(text[end : end + AFTER])}
    moved = SCORES[kind] + (FOR if near & WORDS_FOR[kind] else 0) + (AGAINST if kind != "email" and near & WORDS_AGAINST else 0)
    return round(min(1.0, max(0.0, moved)), 2)


def spans_of(text: str | None) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, base) by start, then by kind as listed."""
    if not text:
        return []
    base = [*emails(text), *numbers(text), *phones(text)]
    found = [(kind, start, end, score(text, kind, start, end), True) for kind, start, end in base]
    taken = sorted((start, end) for _, start, end in base)
    starts, ends = [start for start, _ in taken], [*accumulate((end for _, end in taken), max)]
    for kind, start, end in further(text):
        weight = score(text, kind, start, end)
        before = bisect_left(starts, end)  # base spans that begin before this one's end
        if weight >= LEAST_SCORE and not (before and ends[before - 1] > start):
            found.append((kind, start, end, weight, False))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def personal_data(text: Column) -> Column:
    """array(struct(kind, start, end, score, base)) of a text."""

    @F.pandas_udf(SPANS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("kind", "start", "end", "score", "base")
        for batch in batches:
            yield pd.Series([[dict(zip(names, span)) for span in spans_of(body)] for body in batch])

    return find(text)


def masked(text: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""

    @F.pandas_udf("string")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if body is None else _mask(body) for body in batch], dtype=object)

    return mask(text)


def _mask(text: str) -> str:
    parts, at = [], 0
    for kind, start, end, _, _ in spans_of(text):
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def find_personal_data(docs: DataFrame, text: str = "text", into: str = "found") -> DataFrame:
    """Every row with its spans."""
    return docs.withColumn(into, personal_data(F.col(text)))

"""Archives in which every payload is stored once.

Headers (id, digest, length) are shuffled by payload digest; of the records that share a
payload of at least ``MIN_BYTES`` bytes the one with the greatest id stays a response, the
others become revisit records that refer to it. Payloads move once, to meet the few headers
that change, and are written as record files with fresh headers. Reading follows
Content-Length, so payloads may hold anything, and checks every stored digest.

Defined cases: a null payload is empty; a record with a null id never is the original while
another has an id; a row repeated with the same id and payload stays a response beside its
equal; line breaks in an address are percent-encoded; a revisit given as input refers to the
response of its digest, or to nothing if there is none; an empty table gives archives without
records; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import settle

#: Payload bytes from which a repeated payload is replaced by a revisit.
MIN_BYTES = 1_000
#: Mean payload bytes, and records at most, of one archive file, which is read by one task.
FILE_BYTES, FILE_RECORDS = 64 << 20, 20_000
DATE = "2024-01-01T00:00:00Z"
ID_PREFIX = "urn:record:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
END = "\r\n\r\n"
READ_SCHEMA = (
    "id long, record_type string, uri string, date string, payload_digest string, payload_bytes long, refers_to long"
)


def records_of(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """(id, uri, payload, payload_digest, payload_bytes, given_type), one row per page."""
    body = F.coalesce(F.col(payload), F.lit(""))
    return pages.select(
        F.col(key).cast("long").alias("id"),
        F.col(url).alias("uri"),
        body.alias("payload"),
        F.sha1(body.cast("binary")).alias("payload_digest"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.lit("response").alias("given_type"),
    )


def resolve(records: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Headers that become (or are) revisits: (id, payload_digest, refers_to, refers_uri)."""
    heads = records.select("id", "uri", "payload_digest", "payload_bytes", "given_type")
    originals = (
        heads.filter((F.col("given_type") == "response") & (F.col("payload_bytes") >= min_bytes))
        .groupBy("payload_digest")
        .agg(F.max(F.struct("id", "uri")).alias("original"), F.count(F.lit(1)).alias("n"))
        .select("payload_digest", F.col("original.id").alias("refers_to"), F.col("original.uri").alias("refers_uri"), "n")
    )
    given = F.col("given_type") == "revisit"
    # A payload that occurs once needs no row here, unless a given revisit asks for it.
    repeated = heads.join(originals, "payload_digest", "left").filter(
        given
        | (
            (F.col("n") > 1)
            & F.col("refers_to").isNotNull()
            & ~F.col("id").eqNullSafe(F.col("refers_to"))
            & (F.col("payload_bytes") >= min_bytes)
        )
    )
    return repeated.select("id", "payload_digest", "refers_to", "refers_uri").distinct()


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))


def _address(uri: Column) -> Column:
    return F.replace(F.replace(uri, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _name(number: Column) -> Column:
    return F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(number.cast("string"), F.lit("none")), F.lit(">"))


def write_archives(records: DataFrame, folder: str, min_bytes: int = MIN_BYTES, date: str = DATE) -> str:
    """Write every record once, revisits without their payload; returns the folder."""
    found = resolve(records, min_bytes).select(
        F.col("id").alias("__id"), F.col("payload_digest").alias("__digest"), "refers_to", "refers_uri", F.lit(True).alias("again")
    )
    rows = records.join(
        found, F.col("id").eqNullSafe(F.col("__id")) & (F.col("payload_digest") == F.col("__digest")), "left"
    )
    again = F.coalesce("again", F.lit(False))
    block = F.concat(F.lit(HTTP_HEAD), F.when(again, F.lit("")).otherwise(F.col("payload")))
    referred = again & F.col("refers_to").isNotNull()
    text = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _name(F.col("id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", _address(F.col("uri"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(again, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(referred, _name(F.col("refers_to")))),
        _line("WARC-Refers-To-Target-URI", F.when(referred, _address(F.col("refers_uri")))),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    mean = records.agg(F.avg("payload_bytes")).first()[0] or 1.0
    most = max(1, min(FILE_RECORDS, int(FILE_BYTES / max(mean, 1.0))))
    # The text writer puts the record separator behind every row.
    rows.select(text.alias("value")).write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", most
    ).text(folder)
    return folder


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of every record of a file, gzipped or plain."""
    stream = io.BytesIO(content)
    if content[:2] == b"\x1f\x8b":
        import gzip

        stream = gzip.GzipFile(fileobj=stream)
    while version := stream.readline():
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {version[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a record is cut short")
        yield headers, block


def _number(name: str | None) -> int | None:
    value = (name or "").strip("<>").removeprefix(ID_PREFIX)
    return None if value in ("", "none") else int(value)


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in READ_SCHEMA.split(", ")]

    def frame(rows):
        out = pd.DataFrame(rows, columns=names)
        for name in ("id", "payload_bytes", "refers_to"):
            out[name] = out[name].astype("Int64")
        return out

    for batch in batches:
        for content in batch["content"]:
            rows = []
            for headers, block in parse_archive(bytes(content)):
                kind = headers["warc-type"]
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                payload = block.partition(END.encode())[2]
                size = None
                if kind == "response":
                    size = len(payload)
                    if hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{headers['warc-record-id']} does not have the digest {digest}")
                rows.append(
                    (_number(headers["warc-record-id"]), kind, headers.get("warc-target-uri"), headers["warc-date"], digest, size, _number(headers.get("warc-refers-to")))
                )
                if len(rows) >= 5_000:
                    yield frame(rows)
                    rows = []
            yield frame(rows)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Headers of all records; a revisit's payload_bytes come from the response it refers to."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    heads = settle(files.select("content").mapInPandas(_read, READ_SCHEMA))
    responses = (
        heads.filter("record_type = 'response'")
        .select(F.col("id").alias("__id"), F.col("payload_digest").alias("__digest"), F.col("payload_bytes").alias("__bytes"))
        .distinct()
    )
    revisits = heads.filter("record_type = 'revisit'")
    sized = revisits.join(
        responses, (F.col("refers_to") == F.col("__id")) & (F.col("payload_digest") == F.col("__digest")), "left"
    ).select(*(F.col("__bytes").alias(c) if c == "payload_bytes" else F.col(c) for c in heads.columns))
    return heads.filter("record_type != 'revisit'").unionAll(sized)

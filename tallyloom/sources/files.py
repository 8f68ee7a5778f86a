"""What lies in a folder of extracts: inventory, profile, digests.

Only file names pass through the driver. Profiles and digests are read on the executors,
file by file, in bounded chunks.
"""

from __future__ import annotations

import codecs
import csv
import hashlib
import io
import zlib
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# File patterns, byte order marks, the code pages tried after strict UTF-8,
# and the bytes only the first of them has (euro sign, ellipsis, curly quotes, dashes).
PATTERN = "*.{csv,CSV,txt,TXT}"
CODE_PAGES = ["iso-8859-11", "cp874", "latin-1"]
ONLY_CP874 = {0x80, 0x85, *range(0x91, 0x98)}
BYTE_ORDER_MARKS = [(codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16")]
#: Bytes of a file in which its header is looked for first, and bytes read at a time.
HEAD_BYTES = 1024 * 1024
CHUNK = 1024 * 1024

#: Byte ranges sampled of a file, the bytes of each, and the standard errors an estimate may miss by.
RANGES, RANGE_BYTES, Z = 32, 64 * 1024, 4.0

SAMPLE_SCHEMA = "path string, name string, bytes bigint, bytes_read bigint, bytes_a_row double, rows double, error double"
PROFILE_SCHEMA = (
    "path string, name string, bytes bigint, encoding string, quoted_breaks boolean, leading_rows bigint, header_at bigint, "
    "header array<string>, lines bigint"
)


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Data files of one folder, not below it. No content is read.

    Not in order: a sort would gather the files in few tasks, and what reads them follows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", PATTERN).load(folder)
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def _open(path: str, seekable: bool = False):
    from pyarrow import fs

    # Spark lists paths unescaped; a URI has its special characters escaped.
    uri = quote(path, safe=":/@")
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    system, inner = fs.FileSystem.from_uri(uri)
    return system.open_input_file(inner) if seekable else system.open_input_stream(inner)


def guess_encoding(head: bytes, is_utf8: bool, present: set[int]) -> str:
    """Byte order mark, else UTF-8, else the code page that has all the file's bytes.

    ``is_utf8`` and ``present`` are of the whole file, ``head`` is its beginning. The two
    Thai code pages agree but for the bytes only one has.
    """
    for mark, name in BYTE_ORDER_MARKS:
        if head.startswith(mark):
            return name
    if is_utf8:
        return "utf-8"
    order = sorted(CODE_PAGES[:2], key=lambda name: (name == "cp874") != bool(present & ONLY_CP874))
    for name in [*order, CODE_PAGES[-1]]:
        try:
            bytes(sorted(present)).decode(name)
            return name
        except UnicodeDecodeError:
            continue
    return CODE_PAGES[-1]


def find_header(head: bytes, encoding: str, targets: Sequence[str]) -> tuple[int, list[str]]:
    """Rows up to and with the header, blank lines aside, and the header's cells.

    Without a line that holds a wanted name, the first row is the header.
    """
    rows = [line for line in io.StringIO(head.decode(encoding, errors="replace")).readlines() if line.strip()]
    place = next((i for i, line in enumerate(rows) if any(t in line for t in targets)), 0)
    cells = next(csv.reader([rows[place].rstrip("\r\n")]), []) if rows else []
    return place + 1, cells


def late_header(path: str, encoding: str, targets: Sequence[str]) -> tuple[int, list[str], int] | None:
    """As ``find_header``, line by line through a whole file, and the byte at which the header begins."""
    rows = at = 0
    with _open(path) as stream:
        for line in io.TextIOWrapper(stream, encoding=encoding, errors="replace", newline="\n"):
            if any(t in line for t in targets):
                return rows + 1, next(csv.reader([line.rstrip("\r\n")]), []), at
            rows += bool(line.strip())
            at += len(line.encode(encoding, errors="replace"))
    return None


class Utf8Lines:
    """Are a file's bytes UTF-8? Fed chunk by chunk, judged line by line."""

    def __init__(self):
        self.rest, self.wide, self.bad = b"", 0, 0

    def feed(self, chunk: bytes) -> None:
        whole, end, self.rest = (self.rest + chunk).rpartition(b"\n")
        self._count(whole + end)

    def _count(self, lines: bytes) -> None:
        if lines.isascii():
            return
        try:
            lines.decode("utf-8")
            codes = np.frombuffer(lines, dtype=np.uint8)
            self.wide += len(np.unique(np.searchsorted(np.flatnonzero(codes == 10), np.flatnonzero(codes > 127))))
        except UnicodeDecodeError:
            for line in lines.split(b"\n"):
                if not line.isascii():
                    self.wide += 1
                    try:
                        line.decode("utf-8")
                    except UnicodeDecodeError:
                        self.bad += 1

    def hold(self) -> bool:
        """Most lines beyond ASCII are UTF-8; text of a code page hardly ever is by chance."""
        self._count(self.rest)
        self.rest = b""
        return 2 * self.bad < self.wide or not self.wide


class QuotedBreaks:
    """Do quotes go over line ends on purpose? Fed chunk by chunk.

    A quote that closes a field is followed by a comma, a line end or another quote. Where the
    quotes around a line end are no such pair, the first one was left open.
    """

    AFTER_FIELD = np.frombuffer(b',"\r\n', dtype=np.uint8)

    def __init__(self):
        self.quotes, self.line_ended, self.spans, self.misfits = 0, False, 0, 0

    def feed(self, codes: np.ndarray, ends: np.ndarray) -> None:
        places = np.flatnonzero(codes == 34)
        closing = np.flatnonzero((self.quotes + np.arange(len(places))) % 2 == 1)
        opened = np.where(closing > 0, places[closing - 1], -1) if len(closing) else closing
        over = np.searchsorted(ends, places[closing]) > np.searchsorted(ends, opened)
        if len(closing) and closing[0] == 0:  # opened in an earlier chunk
            over[0] |= self.line_ended
        after = places[closing[over]] + 1
        fits = (after >= len(codes)) | np.isin(codes[np.minimum(after, len(codes) - 1)], self.AFTER_FIELD)
        self.spans, self.misfits = self.spans + int(fits.sum()), self.misfits + int((~fits).sum())
        self.quotes += len(places)
        last = places[-1] if len(places) else -1
        ended = bool(len(ends)) and ends[-1] > last
        self.line_ended = self.quotes % 2 == 1 and (ended or (self.line_ended and not len(places)))

    def hold(self) -> bool:
        return self.spans > self.misfits


def _profile(path: str, size: int, targets: Sequence[str]) -> dict:
    """One pass over all bytes, a chunk at a time."""
    utf8, breaks = Utf8Lines(), QuotedBreaks()
    present = np.zeros(256, dtype=bool)
    head, lines, last = b"", 0, 10
    with _open(path) as stream:
        while chunk := stream.read(CHUNK):
            head = head + chunk[: HEAD_BYTES - len(head)] if len(head) < HEAD_BYTES else head
            codes = np.frombuffer(chunk, dtype=np.uint8)
            present |= np.bincount(codes, minlength=256) > 0
            ends = np.flatnonzero(codes == 10)
            lines, last = lines + len(ends), int(codes[-1])
            breaks.feed(codes, ends)
            if not head.startswith((codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE)):
                utf8.feed(chunk)
    encoding = guess_encoding(head, utf8.hold(), set(np.flatnonzero(present).tolist()))
    leading, cells = find_header(head, encoding, targets)
    # The row lies in the beginning, or, where no row there has a wanted name, anywhere.
    header_at = 0 if leading == 1 else HEAD_BYTES
    if size > HEAD_BYTES and targets and not any(t in c for t in targets for c in cells):
        leading, cells, header_at = late_header(path, encoding, targets) or (leading, cells, header_at)
    return {
        "path": path, "name": path.rsplit("/", 1)[-1], "bytes": size, "encoding": encoding,
        "quoted_breaks": breaks.hold() and encoding != "utf-16", "leading_rows": leading, "header_at": header_at, "header": cells,
        "lines": lines + (last != 10),
    }


def profile(spark: SparkSession, folder: str, targets: Sequence[str] = ()) -> DataFrame:
    """Per file, from all its bytes: encoding, line breaks inside quotes, header, lines.

    A file that cannot be read ends the job: a result without it would be incomplete.
    """
    targets = list(targets)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_profile(p, int(n), targets) for p, n in zip(batch["path"], batch["bytes"])]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PROFILE_SCHEMA.split(", ")])

    return inventory(spark, folder).select("path", "bytes").mapInPandas(run, PROFILE_SCHEMA)


def folder_totals(files: DataFrame) -> DataFrame:
    """Files, bytes and lines of a ``line_counts`` or ``profile`` frame."""
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"),
    )


def line_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(name, bytes, lines) of each file, counted over all its bytes, split by split."""
    lines = spark.read.option("pathGlobFilter", PATTERN).text(folder)
    counted = lines.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count(F.lit(1)).alias("lines")
    )
    return counted.select(F.element_at(F.split("path", "/"), -1).alias("name"), "bytes", "lines")


def _sample_lines(path: str, size: int, ranges: int, width: int, seed: int) -> dict:
    """Line ends in ``ranges`` byte ranges, each at a random place of its own share of the file."""
    if size <= ranges * width:
        starts, width = [0], size  # so little is read whole
    else:
        share = size / ranges
        # The place depends on the file and the seed alone, so a task that is run again repeats it.
        rng = np.random.default_rng([seed, zlib.crc32(path.rsplit("/", 1)[-1].encode()), size])
        starts = [int(k * share + rng.random() * (share - width)) for k in range(ranges)]
    counts = []
    with _open(path, seekable=True) as file:
        for start in starts:
            file.seek(start)
            left, ends = width, 0
            while left and (chunk := file.read(min(CHUNK, left))):
                left, ends = left - len(chunk), ends + chunk.count(b"\n")
            counts.append(ends)
        if size:
            file.seek(size - 1)
        open_end = int(size > 0 and file.read(1) != b"\n")
    found = np.array(counts, dtype=float)
    whole = len(starts) == 1 and width == size
    rows = found[0] if whole else found.mean() * size / width
    # One range in each share: what neighbours differ by bounds the mean's error, whatever changes
    # slowly along the file.
    error = 0.0 if whole else Z * np.sqrt((np.diff(found) ** 2).sum() / (2 * (ranges - 1)) / ranges) * size / width + 1
    return {
        "path": path, "name": path.rsplit("/", 1)[-1], "bytes": size, "bytes_read": len(starts) * width + (size > 0),
        "bytes_a_row": width * len(starts) / max(1.0, found.sum()), "rows": float(rows + open_end), "error": float(error),
    }


def row_samples(spark: SparkSession, folder: str, ranges: int = RANGES, width: int = RANGE_BYTES, seed: int = 0) -> DataFrame:
    """Per file: bytes a row, estimated lines and their error, from ``ranges`` byte ranges.

    ``error`` is ``Z`` standard errors. A file no larger than all its ranges is counted whole,
    without error; empty files are not listed. The bytes read do not grow with the file.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_sample_lines(p, int(n), ranges, width, seed) for p, n in zip(batch["path"], batch["bytes"])]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SAMPLE_SCHEMA.split(", ")])

    return inventory(spark, folder).select("path", "bytes").mapInPandas(run, SAMPLE_SCHEMA)


def sampled_totals(samples: DataFrame) -> DataFrame:
    """Files, bytes, bytes read, estimated lines of a folder and their error (of independent files)."""
    return samples.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("bytes_read"), F.lit(0)).alias("bytes_read"),
        F.coalesce(F.sum("rows"), F.lit(0.0)).alias("rows"),
        F.sqrt(F.coalesce(F.sum(F.col("error") * F.col("error")), F.lit(0.0))).alias("error"),
    )


def _digest(path: str) -> str:
    digest = hashlib.sha256()
    with _open(path) as stream:
        while chunk := stream.read(CHUNK):
            digest.update(chunk)
    return digest.hexdigest()[:16]


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per file the first 16 hex digits of its SHA-256; works for files of any size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(sha256_16=[_digest(p) for p in batch["path"]])[["name", "bytes", "sha256_16"]]

    files = inventory(spark, folder).select("path", "name", "bytes")
    return files.mapInPandas(run, "name string, bytes bigint, sha256_16 string")

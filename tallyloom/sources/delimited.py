"""Ledger extracts as delimited text: mixed code pages, late headers, bad lines.

One profiling job reads every file once and tells how it is written. Files written alike
are read by one scan, and the scans are united by column name.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions.parsing import cell
from tallyloom.sources.files import profile

log = logging.getLogger(__name__)

# Names of the JVM's charsets for the encodings a profile reports.
CHARSETS = {
    "utf-8": "UTF-8",
    "utf-8-sig": "UTF-8",
    "utf-16": "UTF-16",
    "iso-8859-11": "x-iso-8859-11",
    "cp874": "x-windows-874",
    "latin-1": "ISO-8859-1",
}
EXTRA = "_beyond_header"


@dataclass(frozen=True)
class Layout:
    """Columns of an extract: file name to library name; the first is mandatory."""

    columns: dict[str, str]
    loose_names: bool = False

    @property
    def key(self) -> str:
        return next(iter(self.columns))

    def resolve(self, header: Sequence[str]) -> dict[str, int]:
        """Position of each wanted column: exact name, else, with loose names, the first
        column that contains the name or is contained in it."""
        names = [h.lstrip("\ufeff") for h in header]
        places = {}
        for wanted in self.columns:
            if wanted in names:
                places[wanted] = names.index(wanted)
            elif self.loose_names:
                near = [i for i, n in enumerate(names) if n and (wanted in n or n in wanted)]
                places.update({wanted: near[0]} if near else {})
        return places


# The column names of the three extracts.
SYSTEM = Layout(
    {
        "ACC_NO": "acc_no",
        "GROUP_FLAG": "group_flag",
        "FIRST_PAYMENT_DATE": "first_payment_date",
        "PRE_BALANCE": "pre_balance",
        "EXACT_PRE_BALANCE": "exact_pre_balance",
    }
)
COUNTERPART = Layout(
    {"เลขบัญชี": "acc_no", "วันที่เริ่มชำระหนี้": "start_date_be", "ยอดหนี้เงินกู้": "loan_balance"},
    loose_names=True,
)
SCHEDULE = Layout(
    {"ACC_NO": "acc_no", "DUE_PAYMENT_DATE": "due_payment_date", "CAPITAL_REMAIN": "capital_remain"}
)


def read_extract(spark: SparkSession, folder: str, layout: Layout, with_place: bool = False) -> DataFrame:
    """All usable files of a folder, cells as text, with the file each row came from.

    Lines with more fields than the header are left out (``rejected_lines`` lists
    them); short lines are filled with nulls; line breaks inside quotes belong to their
    cell; a file without the key column is skipped with a warning (``skipped_files`` lists
    them). Columns no file has are absent. ``with_place`` adds ``place``, by which the rows of
    a file are in its order however it is split.
    """
    return _united(spark, folder, layout, False, with_place)


def rejected_lines(spark: SparkSession, folder: str, layout: Layout) -> DataFrame:
    """The rows ``read_extract`` leaves out, with what stood beyond the last column."""
    return _united(spark, folder, layout, True)


def load_system(spark: SparkSession, folder: str) -> DataFrame:
    return read_extract(spark, folder, SYSTEM).drop("source_file")


def load_counterpart(spark: SparkSession, folder: str) -> DataFrame:
    return read_extract(spark, folder, COUNTERPART)


def load_schedule(spark: SparkSession, folder: str) -> DataFrame:
    return read_extract(spark, folder, SCHEDULE).drop("source_file")


def skipped_files(spark: SparkSession, folder: str, layout: Layout) -> DataFrame:
    """(name, reason) of the files ``read_extract`` leaves out."""

    @F.pandas_udf("boolean")
    def lacks_key(headers: pd.Series) -> pd.Series:
        return pd.Series([layout.key not in layout.resolve(list(h)) for h in headers], dtype=bool)

    files = profile(spark, folder, list(layout.columns)).where(lacks_key("header"))
    return files.select("name", F.lit(f"no column {layout.key}").alias("reason"))


@dataclass(frozen=True)
class FileGroup:
    """Files that are written alike."""

    paths: list[str]
    encoding: str
    header: tuple[str, ...]
    quoted_breaks: bool
    leading_rows: int
    #: No header begins behind this byte.
    header_at: int

    @property
    def charset(self) -> str:
        return CHARSETS[self.encoding]

    @property
    def whole_records(self) -> bool:
        """A quoted line break, or two-byte characters, forbid splitting a file by line."""
        return self.quoted_breaks or self.charset == "UTF-16"


def file_groups(spark: SparkSession, folder: str, layout: Layout) -> list[FileGroup]:
    """The usable files of a folder, grouped by how they are written."""
    # One short row per file; Spark's own file listing is no smaller.
    found = profile(spark, folder, list(layout.columns)).collect()
    groups: dict[tuple, list] = {}
    for file in sorted(found, key=lambda f: f["name"]):
        if layout.key not in layout.resolve(file["header"]):
            log.warning("%s has no column %s and is skipped", file["name"], layout.key)
        else:
            how = (file["encoding"], tuple(file["header"]), file["quoted_breaks"], file["leading_rows"])
            groups.setdefault(how, []).append(file)
    if not groups:
        raise FileNotFoundError(f"no usable data file in {folder}")
    kept = [FileGroup([f["path"] for f in files], *how, max(f["header_at"] for f in files)) for how, files in groups.items()]
    if any(g.charset not in ("UTF-8", "UTF-16", "ISO-8859-1") for g in kept):
        # Spark reads these code pages only with the JVM's full charset list.
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    return kept


def placed(rows: DataFrame) -> DataFrame:
    """A file scan's rows with the file's name and where each one stands, for ``below_header``."""
    return rows.withColumns(
        {
            "source_file": file_name(),
            "_path": F.col("_metadata.file_path"),
            "_start": F.col("_metadata.file_block_start"),
            "_at": F.monotonically_increasing_id(),
        }
    )


def file_name() -> Column:
    """The scan reports names percent-escaped, with plus signs left alone."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def below_header(rows: DataFrame, group: FileGroup) -> DataFrame:
    """Without the rows up to the header, which are the first of the file's first blocks, by position."""
    place = F.row_number().over(Window.partitionBy("_path").orderBy("_start", "_at"))
    early = F.col("_start") <= group.header_at
    first = rows.where(early).withColumn("_place", place).where(F.col("_place") > group.leading_rows).drop("_place")
    return first.unionByName(rows.where(~early))


def _united(spark, folder, layout, rejected, with_place=False) -> DataFrame:
    scans = [_scan(spark, group, layout, rejected, with_place) for group in file_groups(spark, folder, layout)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _scan(spark, group: FileGroup, layout, rejected, with_place) -> DataFrame:
    names = [f"c{i}" for i in range(len(group.header))]
    late = group.leading_rows > 1
    reader = (
        spark.read.schema(", ".join(f"{n} string" for n in [*names, EXTRA]))
        .option("mode", "PERMISSIVE")
        .option("encoding", group.charset)
        .option("escape", '"')
        .option("multiLine", group.whole_records)
        .option("header", not late)
    )
    rows = placed(reader.csv(group.paths))
    if late:
        rows = below_header(rows, group)
    kept = rows.where(F.col(EXTRA).isNotNull() if rejected else F.col(EXTRA).isNull())
    chosen: list[Column] = [
        cell(f"c{i}").alias(layout.columns[wanted]) for wanted, i in layout.resolve(group.header).items()
    ]
    more = [F.col(EXTRA).alias("beyond_header")] if rejected else []
    if with_place:
        # A block's rows keep their order within one task; a later block begins at a later byte.
        more.append(F.struct(F.col("_start").alias("block"), F.col("_at").alias("row")).alias("place"))
    return kept.select(*chosen, "source_file", *more)

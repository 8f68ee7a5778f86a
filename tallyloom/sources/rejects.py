"""Strict reading of extracts: every line is kept or rejected for a reason, and counted.

Lines are read as they lie, bytes and all, so a line can be judged before a parser touches it.
The first reason that holds is the line's:

* ``undecodable``: its bytes are no text in the file's code page;
* ``open_quote``: its quotes do not pair up;
* ``long_line``, ``short_line``: it has more, or fewer, fields than the header;
* otherwise it is kept.

Where the quotes around line ends are pairs, as fields with line breaks have them, a record
stands for a line. Any other file is read line by line, so that an open quote costs its own line
and not the rest of the file. Blank lines and the rows up to the header are
neither kept nor rejected.

Defined cases: a file without the key column is skipped (``skipped_files`` names it); a folder
without a usable file raises FileNotFoundError; a quote inside an unquoted field counts as a
quote; fields are counted outside quotes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.parsing import cell
from tallyloom.sources import delimited as dl

KEPT = "kept"
REASONS = ["undecodable", "open_quote", "long_line", "short_line"]
#: What a byte that is no text becomes when a code page is read.
UNREADABLE = "�"
RECORD = "_record"


def reason_of(line: Column, readable: Column, width: int) -> Column:
    """Why a line of a file with ``width`` columns is rejected, or KEPT."""
    # Doubled quotes inside a field leave the number of quotes even.
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    bare = F.regexp_replace(line, '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return (
        F.when(~readable, REASONS[0])
        .when(quotes % 2 == 1, REASONS[1])
        .when(fields > width, REASONS[2])
        .when(fields < width, REASONS[3])
        .otherwise(KEPT)
    )


def judged(spark: SparkSession, folder: str, layout: dl.Layout) -> DataFrame:
    """(wanted cells…, source_file, line, reason) of every line; rejected ones have no cells."""
    parts = [_judged(spark, group, layout) for group in dl.file_groups(spark, folder, layout)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_strict(spark: SparkSession, folder: str, layout: dl.Layout) -> DataFrame:
    """The lines without fault, as ``read_extract`` gives them."""
    return judged(spark, folder, layout).filter(F.col("reason") == KEPT).drop("line", "reason")


def rejects(spark: SparkSession, folder: str, layout: dl.Layout) -> DataFrame:
    """(source_file, reason, line) of the lines ``read_strict`` leaves out."""
    return judged(spark, folder, layout).filter(F.col("reason") != KEPT).select("source_file", "reason", "line")


def rejects_by_reason(spark: SparkSession, folder: str, layout: dl.Layout) -> DataFrame:
    """(source_file, reason, rows), kept lines among them: the rows add up to the lines."""
    return judged(spark, folder, layout).groupBy("source_file", "reason").agg(F.count(F.lit(1)).alias("rows"))


def _judged(spark: SparkSession, group: dl.FileGroup, layout: dl.Layout) -> DataFrame:
    lines = _records(spark, group) if group.whole_records else _lines(spark, group)
    names = [f"c{i}" for i in range(len(group.header))]
    width = len(names)
    lines = lines.withColumn("reason", reason_of(F.col("line"), F.col("readable"), width))
    # Only whole lines reach the parser, which then cannot fail on their width.
    schema = ", ".join(f"{n} string" for n in names)
    parsed = F.when(F.col("reason") == KEPT, F.from_csv("line", schema, {"escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}))
    chosen = [cell(f"_cells.c{i}").alias(layout.columns[wanted]) for wanted, i in layout.resolve(group.header).items()]
    return lines.withColumn("_cells", parsed).select(*chosen, "source_file", "line", "reason")


def _lines(spark: SparkSession, group: dl.FileGroup) -> DataFrame:
    """(line, readable, source_file) below the header, split by line; bytes stay as they are."""
    raw = dl.placed(spark.read.text(group.paths))
    raw = dl.below_header(raw.where(F.trim("value") != ""), group)
    if group.charset == "UTF-8":
        return raw.select(F.col("value").alias("line"), F.is_valid_utf8("value").alias("readable"), "source_file")
    text = F.decode(F.col("value").cast("binary"), group.charset)
    return raw.select(text.alias("line"), ~F.contains(text, F.lit(UNREADABLE)), "source_file").toDF("line", "readable", "source_file")


def _records(spark: SparkSession, group: dl.FileGroup) -> DataFrame:
    """As ``_lines``, for files with line breaks inside quotes or two-byte characters."""
    # With one column and no delimiter that could occur, a record comes back as it was written,
    # but for its outer quotes; so the parser is asked for the record itself, as a corrupt one.
    names = [f"c{i}" for i in range(len(group.header) + 1)]
    schema = ", ".join(f"{n} string" for n in [*names, RECORD])
    rows = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RECORD)
        .option("encoding", group.charset)
        .option("escape", '"')
        .option("multiLine", True)
        .csv(group.paths)
    )
    # A record with exactly one field too many fits the schema and is written out again.
    again = F.concat_ws(",", *(F.coalesce(F.col(n), F.lit("")) for n in names))
    line = F.coalesce(RECORD, again)
    return dl.below_header(dl.placed(rows), group).select(line.alias("line"), ~F.contains(line, F.lit(UNREADABLE)), "source_file").toDF("line", "readable", "source_file")

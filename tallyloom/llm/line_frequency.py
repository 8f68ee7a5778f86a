"""Lines that a site repeats on too many of its pages.

A line is boilerplate of its host where the pages that hold it exceed a ratio of all pages
of that host. Built-in expressions only.

Defined cases: a null text stays null and counts as a page; a null host is no site, so its
lines stay; blank lines are never boilerplate; a line repeated on one page counts once;
lines are compared without blanks, tabs and carriage returns at their ends; a host needs
``min_pages`` pages with the line, so that small sites keep their text; repeated rows are
pages of their own, but with ``copies_once`` a host's pages of the same lines in the same order
are one page, so that a text does not become boilerplate by its copies; an empty table gives an
empty result. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import settle

#: Share of a host's pages above which a line is boilerplate.
RATIO = 0.1
#: Pages of a host that must hold the line.
MIN_PAGES = 5
#: Flagged lines (16 bytes each) up to which they are broadcast; a shuffle join beyond.
BROADCAST_LINES = 200_000


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(_bare(line).cast("binary")))


def boilerplate_lines(
    docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False
) -> DataFrame:
    """(site, digest, pages, site_pages) of every line over the ratio."""
    pages = docs.select(F.col(host).alias("site"), F.col(text).alias("body")).filter("site is not null")
    lines = F.filter(F.split("body", "\n"), lambda line: _bare(line) != "")
    digests = F.array_distinct(F.transform(lines, _digest))
    if copies_once:
        content = F.array_join(F.transform(lines, _bare), "\n")
        # Below the explode, or it would be computed once a line.
        pages = pages.withColumn("page", F.unhex(F.md5(F.coalesce(content, F.lit("")).cast("binary"))))
        counted = pages.select("site", "page").distinct()
        held = pages.select("site", "page", F.explode(digests).alias("digest")).distinct()
    else:
        counted, held = pages, pages.select("site", F.explode(digests).alias("digest"))
    totals = counted.groupBy("site").agg(F.count(F.lit(1)).alias("site_pages"))
    counts = (
        held.groupBy("site", "digest")
        .agg(F.count(F.lit(1)).alias("pages"))
        .filter(F.col("pages") >= min_pages)
    )
    return counts.join(totals, "site").filter(F.col("pages") > F.lit(float(ratio)) * F.col("site_pages"))


def drop_boilerplate(
    docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False
) -> DataFrame:
    """Every row with boilerplate lines taken out of its text, and ``lines_dropped``.

    A host has at most (mean lines of a page / ratio) flagged lines, so one array holds them.
    """
    flagged = settle(boilerplate_lines(docs, text, host, ratio, min_pages, copies_once).select("site", "digest"))
    flags = flagged.groupBy(F.col("site").alias("__site")).agg(F.collect_set("digest").alias("__flags"))
    if flagged.count() <= BROADCAST_LINES:
        flags = F.broadcast(flags)
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda line: ~F.array_contains("__flags", _digest(line)))
    found = F.col("__flags").isNotNull() & F.col(text).isNotNull()
    return (
        docs.join(flags, docs[host] == flags["__site"], "left")
        .withColumn("__kept", F.when(found, kept))
        .withColumn("lines_dropped", F.when(found, F.size(lines) - F.size("__kept")).otherwise(F.lit(0)))
        .withColumn(text, F.when(found, F.array_join("__kept", "\n")).otherwise(F.col(text)))
        .drop("__site", "__flags", "__kept")
    )

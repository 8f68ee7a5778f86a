"""Result files: six record lists, the report payload, the manifest."""

from __future__ import annotations

import os
import platform
import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import comparing as cmp
from tallyloom.operators import dedup as dd
from tallyloom.operators import matching as mt
from tallyloom.operators import summary as sm
from tallyloom.operators.topn import scatter_cells, top_rows
from tallyloom.plans.reconcile import Reconciliation
from tallyloom.session import settle
from tallyloom.sinks.versions import Version, Versions
from tallyloom.sources.files import digests

VERSION = "1.0.0"
BYTE_ORDER_MARK = "\ufeff"
JSON_OPTIONS = {"dateFormat": "yyyy-MM-dd"}


def record_lists(r: Reconciliation) -> dict[str, DataFrame]:
    """The record lists of a run; those about the schedule only where there is one."""
    lists = {
        "errors_ab": mt.ab_rows(r.ab, errors_only=True),
        "debt_separation": mt.debt_separation(r.ab),
        "conflicts": dd.conflict_records(r.typed, r.guard),
    }
    if r.schedule is not None:
        lists["errors_sb"] = mt.sb_rows(r.sb, errors_only=True)
        lists["three_way_perfect"] = mt.three_rows(r.three, "perfect").drop("kind")
        lists["three_way_discrepancies"] = mt.three_rows(r.three, "discrepancy").drop("kind")
    return lists


def write_csv(df: DataFrame, path: str, spreadsheet: bool = True, charset: str = "UTF-8") -> None:
    """One folder of CSV files, replaced as a whole by the output committer.

    With ``spreadsheet`` the first header name starts with a byte order mark.
    """
    if spreadsheet:
        df = df.withColumnRenamed(df.columns[0], BYTE_ORDER_MARK + df.columns[0])
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"').option("encoding", charset)
    # Cells keep their blanks: tidying is the reader's business.
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


class Staged:
    """Outputs written beside their places and moved there at the end, one after another.

    A run that fails before ``publish`` leaves the outputs of the run before as they were;
    ``versions.Versions`` holds that for a failure at any point.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.stage = f"{self.folder}/_staged-{uuid.uuid4().hex[:12]}"
        self.names: list[str] = []

    def path(self, name: str) -> str:
        self.names.append(name)
        return f"{self.stage}/{name}"

    def publish(self) -> dict[str, str]:
        """Name to final path of every output."""
        path_of = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path_of(self.stage).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for name in self.names:
            final = path_of(f"{self.folder}/{name}")
            files.delete(final, True)
            if not files.rename(path_of(f"{self.stage}/{name}"), final):
                raise OSError(f"{name} cannot be moved into {self.folder}")
        files.delete(path_of(self.stage), True)
        return {name: f"{self.folder}/{name}" for name in self.names}


def stage_lists(r: Reconciliation, staged: Staged | Version, max_records: int | None = None) -> None:
    """Every list is written, empty or not, so no stale file outlives a run.

    Lists are whole; ``max_records`` is for callers who want only the first rows.
    """
    for name, rows in record_lists(r).items():
        write_csv(top_rows(rows, rows.columns, max_records), staged.path(name))


def staging(spark: SparkSession, folder: str, versioned: bool) -> Staged | Version:
    """Where a run writes: beside fixed places, or as a version that becomes current at once."""
    return Versions(spark, folder).begin() if versioned else Staged(spark, folder)


def write_lists(r: Reconciliation, folder: str, max_records: int | None = None, versioned: bool = False) -> dict[str, str]:
    staged = staging(r.system.sparkSession, folder, versioned)
    stage_lists(r, staged, max_records)
    return staged.publish()


def report_payload(r: Reconciliation) -> DataFrame:
    """One row with the report as JSON: summaries, size of each list, chart series.

    The lists themselves grow with the ledgers; they are the files of ``write_lists``.
    """
    def row(df: DataFrame):
        return df.select(F.struct("*").alias("r")).scalar()

    def series(df: DataFrame):
        # Histograms and shares have a fixed number of rows.
        return df.agg(F.sort_array(F.collect_list(F.struct("*"))).alias("l")).scalar()

    def compared(name: str, frame: DataFrame, counted: list[DataFrame]) -> list:
        return [
            row(sm.balance_error_stats(frame)).alias(f"balance_errors_{name}"),
            series(sm.error_histogram(frame)).alias(f"histogram_{name}"),
            series(sm.class_shares(sm.class_counts(*counted))).alias(f"classes_{name}"),
        ]

    parts = compared("ab", r.ab, r.ab_counted)
    stats = [row(r.dedup_report).alias("dedup"), row(r.ab_summary).alias("ab")]
    if r.schedule is not None:
        stats += [
            row(r.sb_summary).alias("sb"),
            row(r.three_summary).alias("three_way"),
            row(sm.dashboard_totals(r.ab_summary, r.sb_summary)).alias("totals"),
        ]
        parts += compared("sb", r.sb, r.sb_counted)
        parts.append(series(sm.class_shares(sm.class_counts(*r.three_counted))).alias("classes_three_way"))
    stats.append(row(sm.date_diff_stats(r.ab)).alias("date_gaps"))
    charts = [row(sm.quality_metrics(r.ab_summary)).alias("quality"), *parts]
    filled = r.system.sparkSession.range(1).select(F.struct(*stats).alias("stats"), F.struct(*charts).alias("charts"))
    document = F.struct(F.lit(VERSION).alias("version"), "stats", list_rows(r).alias("list_rows"), "charts")
    return filled.select(F.to_json(document, JSON_OPTIONS).alias("payload"))


def list_rows(r: Reconciliation) -> Column:
    """Size of each record list, from the counters in the column ``stats``: no list is built for it."""

    def errors(name: str) -> Column:
        return sum((F.col(f"stats.{name}.{c}") for c in (cmp.BALANCE_ONLY, cmp.BOTH)), F.col(f"stats.{name}.{cmp.DATE_ONLY}"))

    sizes = {
        "errors_ab": errors("ab"),
        "debt_separation": F.col("stats.ab.debt_separation_cases"),
        "conflicts": F.col("stats.dedup.conflict_records"),
    }
    if r.schedule is not None:
        sizes["errors_sb"] = errors("sb")
        sizes["three_way_perfect"] = F.col(f"stats.three_way.{cmp.PERFECT}")
        sizes["three_way_discrepancies"] = errors("three_way")
    return F.struct(*(size.cast("bigint").alias(name) for name, size in sizes.items()))


def read_payload(payload: DataFrame, schema: str) -> DataFrame:
    """The parts of a report that ``schema`` names."""
    return payload.select(F.from_json("payload", schema, JSON_OPTIONS).alias("p")).select("p.*")


def manifest_files(spark: SparkSession, inputs: dict[str, str]) -> DataFrame:
    """One row per input file: ledger, name, size, short digest."""
    parts = [digests(spark, path).withColumn("ledger", F.lit(name)) for name, path in inputs.items()]
    return reduce(lambda a, b: a.unionByName(b), parts).select("ledger", "name", "bytes", "sha256_16")


def manifest(
    r: Reconciliation, inputs: dict[str, str], outputs: dict[str, str], seconds: float | None = None
) -> DataFrame:
    """One row: version, folders, statistics, throughput, environment.

    ``seconds`` is the time the comparisons took.
    """
    spark = r.system.sparkSession
    stats = {"dedup": r.dedup_report, "ab": r.ab_summary}
    if r.schedule is not None:
        stats |= {"sb": r.sb_summary, "three_way": r.three_summary}

    def named(texts: dict[str, str]):
        return F.struct(*[F.lit(text).alias(name) for name, text in texts.items()])

    rows = F.col("statistics.ab.rows_a") + F.col("statistics.dedup.original_rows")
    if r.schedule is not None:
        rows = rows + F.col("statistics.sb.rows_s")
    speed = F.struct(
        rows.alias("rows"),
        F.lit(seconds).cast("double").alias("seconds"),
        (rows / F.greatest(F.lit(seconds).cast("double"), F.lit(0.001))).alias("rows_per_second"),
    )
    return (
        spark.range(1)
        .select(
            F.lit(VERSION).alias("version"),
            F.current_timestamp().alias("generated_at"),
            named(inputs).alias("inputs"),
            named(outputs).alias("outputs"),
            F.struct(*[df.select(F.struct("*")).scalar().alias(n) for n, df in stats.items()]).alias("statistics"),
            named({"python": platform.python_version(), "spark": spark.version}).alias("environment"),
        )
        .withColumn("throughput", speed)
    )


def run(
    spark: SparkSession,
    folders: dict[str, str],
    output: str,
    max_records: int | None = None,
    dry_run: bool = False,
    with_report: bool = False,
    versioned: bool = False,
    **options,
) -> DataFrame:
    """The whole program: read the extracts, compare, write; gives the summary matrix.

    ``folders`` names the extracts ``system``, ``counterpart`` and, if there is one,
    ``schedule``. A dry run writes nothing. With ``versioned`` all outputs become current at
    once and are read through ``Versions``; else each is moved to its fixed place in turn.
    """
    from tallyloom.sources.delimited import load_counterpart, load_schedule, load_system

    r = Reconciliation(
        load_system(spark, folders["system"]),
        load_counterpart(spark, folders["counterpart"]),
        load_schedule(spark, folders["schedule"]) if folders.get("schedule") else None,
        keep=True,
        **options,
    )
    try:
        begun = time.monotonic()
        matrix = settle(r.matrix())
        seconds = time.monotonic() - begun
        if dry_run:
            return matrix
        staged = staging(spark, output, versioned)
        stage_lists(r, staged, max_records)
        if with_report:
            report_payload(r).write.text(staged.path("report"))
            scatter_cells(mt.ab_rows(r.ab, errors_only=True)).write.json(staged.path("scatter"))
        given = {n: p for n, p in folders.items() if p}
        written = {name: os.path.join(staged.stage if versioned else output, name) for name in record_lists(r)}
        manifest(r, given, written, seconds).write.json(staged.path("manifest"))
        manifest_files(spark, given).write.json(staged.path("manifest_files"))
        staged.publish()
        return matrix
    finally:
        r.release()

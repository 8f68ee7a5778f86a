"""Counters, rates, error statistics, histogram and quality scores.

Each summary is one row, put together from one-row aggregates over the compared
frames. All sums weigh a row by ``copies``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import comparing as cmp
from tallyloom.operators.matching import is_active, is_error
from tallyloom.operators.quantiles import quantiles, value_counts
from tallyloom.session import settle
from tallyloom.operators.skew import COPIES

# The bonus in the integrity score, and the histogram's bins and cut.
INTEGRITY_BONUS = 5
HISTOGRAM_BINS = 50
HISTOGRAM_CUT = 0.99


def rows_where(condition: Column) -> Column:
    """Joined rows that satisfy the condition; zero on empty input."""
    weight = F.when(F.coalesce(condition, F.lit(False)), F.col(COPIES)).otherwise(F.lit(0))
    return F.coalesce(F.sum(weight), F.lit(0))


def one_row(*parts: DataFrame) -> DataFrame:
    """Put one-row frames side by side without joining them."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(f"`{c}`").alias(c) for c in stacked.columns])


def add_rows(parts: Sequence[DataFrame]) -> DataFrame:
    """Sum one-row counters column by column."""
    if len(parts) == 1:
        return parts[0]
    stacked = reduce(lambda a, b: a.unionByName(b), parts)
    return stacked.agg(*[F.sum(c).alias(c) for c in stacked.columns])


def class_counts(compared: DataFrame, *more: DataFrame) -> DataFrame:
    """Matched rows per class; all four classes, zero where empty.

    ``more`` are counters of rows kept out of ``compared``.
    """
    counts = compared.agg(
        rows_where(F.col("mismatch").isNotNull()).alias("matched_rows"),
        *[rows_where(F.col("mismatch") == name).alias(name) for name in cmp.CLASSES],
    )
    return add_rows([counts, *[m.select(*counts.columns) for m in more]])


def exact_balance_checks(compared: DataFrame, *more: DataFrame) -> DataFrame:
    matched = F.col("matched")
    counts = compared.agg(
        rows_where(matched & ~F.col("exact_vs_b_match")).alias("exact_vs_b_mismatches"),
        rows_where(matched & ~F.col("exact_vs_pre_match")).alias("exact_vs_pre_mismatches"),
        rows_where(matched & F.col("is_debt_separation")).alias("debt_separation_cases"),
    )
    return add_rows([counts, *[m.select(*counts.columns) for m in more]])


def ab_summary(system: DataFrame, counterpart: DataFrame, compared: DataFrame, *more: DataFrame) -> DataFrame:
    """Counts and rates of the A-B comparison.

    ``system`` is the raw ledger, ``counterpart`` the cleaned one, ``compared`` the
    result of ``compare_ab``, ``more`` counters of rows kept out of it.
    """
    matched = F.col("matched")
    counts = compared.agg(
        rows_where(matched).alias("matched_rows"),
        rows_where(~matched).alias("unmatched_b"),
        *[rows_where(F.col("mismatch") == name).alias(name) for name in cmp.CLASSES],
        rows_where(matched & ~F.col("exact_vs_b_match")).alias("exact_vs_b_mismatches"),
        rows_where(matched & ~F.col("exact_vs_pre_match")).alias("exact_vs_pre_mismatches"),
        rows_where(matched & F.col("is_debt_separation")).alias("debt_separation_cases"),
        rows_where(matched & (F.col("bad_balance_a") | F.col("bad_balance_b"))).alias("bad_balances"),
    )
    merged = one_row(
        system.agg(F.count(F.lit(1)).alias("rows_a"), F.count_if(is_active(system)).alias("active_rows_a")),
        _counterpart_rows(counterpart),
        add_rows([counts, *[m.select(*counts.columns) for m in more]]),
    )
    return _with_rates(merged)


def sb_summary(schedule: DataFrame, counterpart: DataFrame, compared: DataFrame, *more: DataFrame) -> DataFrame:
    matched = F.col("matched")
    counts = compared.agg(
        rows_where(matched).alias("matched_rows"),
        rows_where(~matched).alias("unmatched_b"),
        *[rows_where(F.col("mismatch") == name).alias(name) for name in cmp.CLASSES],
        rows_where(matched & (F.col("bad_balance_s") | F.col("bad_balance_b"))).alias("bad_balances"),
    )
    merged = one_row(
        schedule.agg(F.count(F.lit(1)).alias("rows_s")),
        _counterpart_rows(counterpart),
        add_rows([counts, *[m.select(*counts.columns) for m in more]]),
    )
    return _with_rates(merged)


def _counterpart_rows(counterpart: DataFrame) -> DataFrame:
    return counterpart.agg(
        F.count(F.lit(1)).alias("rows_b"),
        F.count_if(F.col("acc_key").isNull()).alias("rows_b_no_key"),
        F.count_if(F.col("acc_key") == "").alias("rows_b_empty_key"),
    )


def _with_rates(merged: DataFrame) -> DataFrame:
    errors = F.col(cmp.DATE_ONLY) + F.col(cmp.BALANCE_ONLY) + F.col(cmp.BOTH)
    matched = F.col("matched_rows")
    return merged.withColumns(
        {
            "match_rate_pct": F.round(cmp.percent(matched, F.col("rows_b")), 2),
            "error_rate_pct": F.round(cmp.percent(errors, matched), 2),
            "accuracy_rate_pct": F.round(cmp.percent(F.col(cmp.PERFECT), matched), 2),
        }
    )


def three_summary(
    system: DataFrame, counterpart: DataFrame, schedule: DataFrame, compared: DataFrame, *more: DataFrame
) -> DataFrame:
    """Counts and rates of the three-way comparison; the first three are cleaned ledgers."""
    merged = one_row(
        system.agg(F.count(F.lit(1)).alias("active_rows_a")),
        counterpart.agg(F.count(F.lit(1)).alias("rows_b")),
        schedule.agg(F.count(F.lit(1)).alias("rows_s")),
        class_counts(compared, *more),
    )
    widest = F.greatest("active_rows_a", "rows_b", "rows_s")
    return merged.withColumns(
        {
            "match_rate_pct": F.round(cmp.percent(F.col("matched_rows"), widest), 2),
            "perfect_match_rate_pct": F.round(cmp.percent(F.col(cmp.PERFECT), F.col("matched_rows")), 2),
        }
    )


# ---- error statistics -----------------------------------------------------


def _moments(counts: DataFrame) -> DataFrame:
    """Weighted mean, population deviation, ends; two passes to keep the digits."""
    total = F.sum("n").cast("double")
    mean = counts.agg((F.sum(F.col("v") * F.col("n")) / total).alias("mean")).scalar()
    apart = F.col("v") - mean
    return counts.agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("v") * F.col("n")) / total).alias("mean"),
        F.sqrt(F.sum(apart * apart * F.col("n")) / total).alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )


def _stats(counts: DataFrame, wanted: dict[str, float], digits: int = 4) -> DataFrame:
    merged = one_row(_moments(counts), quantiles(counts, wanted))
    names = ["mean", "median", "std", "min", "max", *[n for n in wanted if n != "median"]]
    zero = F.lit(0.0)
    return merged.select(
        F.coalesce("n", F.lit(0)).alias("n"),
        *[F.round(F.coalesce(F.col(n).cast("double"), zero), digits).alias(n) for n in names],
    )


def balance_error_stats(compared: DataFrame) -> DataFrame:
    """Signed balance gaps of the rows in error; zeros where there are none."""
    counts = settle(value_counts(compared.where(is_error()), F.col("bal_diff").cast("double"), F.col(COPIES)))
    return _stats(counts, {"median": 0.5, "p95": 0.95, "p99": 0.99})


def date_diff_stats(compared: DataFrame) -> DataFrame:
    """Day gaps of the rows in error whose two dates are usable."""
    rows = compared.where(is_error() & F.col("dates_usable"))
    counts = settle(value_counts(rows, F.col("date_diff_days").cast("double"), F.col(COPIES)))
    return _stats(counts, {"median": 0.5})


def approximate_stats(compared: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """One-pass variant of ``balance_error_stats`` with sketched quantiles."""
    gap, weight = F.col("bal_diff"), F.col(COPIES)
    marks = F.expr(f"percentile_approx(bal_diff, array(0.5, 0.95, 0.99), {accuracy})")
    total = F.sum(weight)
    mean = F.sum(gap * weight) / total
    # Copies are weights; a sketch has none, so its ranks are those of the collapsed rows.
    row = compared.where(is_error()).agg(
        F.coalesce(total, F.lit(0)).alias("n"),
        mean.alias("mean"),
        marks[0].alias("median"),
        F.sqrt(F.greatest(F.lit(0.0), F.sum(gap * gap * weight) / total - mean * mean)).alias("std"),
        F.min(gap).alias("min"),
        F.max(gap).alias("max"),
        marks[1].alias("p95"),
        marks[2].alias("p99"),
    )
    return row.select("n", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in row.columns if c != "n"])


# ---- histogram ------------------------------------------------------------


def error_histogram(compared: DataFrame, bins: int = HISTOGRAM_BINS, cut: float = HISTOGRAM_CUT) -> DataFrame:
    """Equal bins over the gaps below the cut quantile of their absolute value.

    Bins are closed on the left, the last on both sides; empty bins are listed; no
    bins at all where no gap is below the cut.
    """
    counts = settle(value_counts(compared.where(is_error()), F.col("bal_diff").cast("double"), F.col(COPIES)))
    sizes = value_counts(counts, F.abs("v"), F.col("n"))
    limit = quantiles(sizes, {"limit": cut}).scalar()
    kept = counts.where(F.abs("v") < limit)
    # A single value still gets a bin of its own width.
    lo, hi = F.min("v"), F.max("v")
    half = F.when(lo == hi, F.lit(0.5)).otherwise(F.lit(0.0))
    ends = kept.agg(F.struct((lo - half).alias("low"), (hi + half).alias("high")).alias("ends")).scalar()
    low, high = ends["low"], ends["high"]

    slot = F.least(F.floor((F.col("v") - low) * bins / (high - low)), F.lit(bins - 1)) + 1
    filled = kept.groupBy(slot.cast("int").alias("bin")).agg(F.sum("n").alias("rows"))
    every = compared.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    step = (high - low) / F.lit(bins)
    return (
        every.join(filled, "bin", "left")
        .select(
            "bin",
            F.round(low + step * (F.col("bin") - 1), 4).alias("low_edge"),
            F.round(low + step * F.col("bin"), 4).alias("high_edge"),
            F.coalesce("rows", F.lit(0)).alias("rows"),
        )
        .where(F.col("low_edge").isNotNull())
    )


def merged_bins(histogram: DataFrame, limit: int = 25) -> DataFrame:
    """Neighbouring bins in pairs where there are more than ``limit``; every row stays counted."""
    many = histogram.agg((F.count(F.lit(1)) > limit).alias("many")).scalar()
    place = F.when(many, F.ceil(F.col("bin") / 2)).otherwise(F.col("bin")).cast("int")
    return histogram.groupBy(place.alias("bin")).agg(
        F.min("low_edge").alias("low_edge"), F.max("high_edge").alias("high_edge"), F.sum("rows").alias("rows")
    )


# ---- scores and report rows ----------------------------------------------


def quality_metrics(summary: DataFrame) -> DataFrame:
    """Four scores from the A-B summary; rows wrong in both ways lower neither score."""
    base = F.greatest("matched_rows", F.lit(1)).cast("double")
    accuracy = cmp.percent(F.col(cmp.PERFECT), F.col("matched_rows"))

    def score(wrong: str) -> Column:
        return F.greatest(F.lit(0.0), 100.0 - F.col(wrong) / base * 100.0)

    return summary.select(
        F.round(F.least(F.lit(100.0), accuracy + INTEGRITY_BONUS), 1).alias("integrity"),
        F.round(cmp.percent(F.col("matched_rows"), F.col("rows_b")), 1).alias("coverage"),
        F.round(score(cmp.DATE_ONLY), 1).alias("date_accuracy"),
        F.round(score(cmp.BALANCE_ONLY), 1).alias("balance_accuracy"),
    )


def class_shares(summary: DataFrame) -> DataFrame:
    """Each class as a share of the matched rows, one decimal."""
    names = F.explode(
        F.array(*[F.struct(F.lit(n).alias("mismatch"), F.col(n).alias("rows")) for n in cmp.CLASSES])
    )
    return summary.select("matched_rows", names.alias("c")).select(
        "c.mismatch", "c.rows", F.round(cmp.percent(F.col("c.rows"), F.col("matched_rows")), 1).alias("share_pct")
    )


def dashboard_totals(ab: DataFrame, sb: DataFrame) -> DataFrame:
    """Rows read, rows matched and rows in error over both two-way comparisons."""

    def errors(summary: DataFrame, suffix: str) -> DataFrame:
        return summary.select(
            F.col("matched_rows").alias(f"matched_{suffix}"),
            (F.col(cmp.DATE_ONLY) + F.col(cmp.BALANCE_ONLY) + F.col(cmp.BOTH)).alias(f"errors_{suffix}"),
        )

    merged = one_row(ab.select("rows_a", "rows_b"), sb.select("rows_s"), errors(ab, "ab"), errors(sb, "sb"))
    return merged.select(
        (F.col("rows_a") + F.col("rows_b") + F.col("rows_s")).alias("total_rows"),
        (F.col("matched_ab") + F.col("matched_sb")).alias("matched_rows"),
        (F.col("errors_ab") + F.col("errors_sb")).alias("error_rows"),
    )


def summary_matrix(
    ab: DataFrame, sb: DataFrame | None, three: DataFrame | None, report: DataFrame
) -> DataFrame:
    """Nine metrics by comparison; null where a comparison has no such number."""
    classes = [F.col(c) for c in (cmp.PERFECT, cmp.DATE_ONLY, cmp.BALANCE_ONLY)]
    pick = {
        "ab": ab.select(
            F.col("rows_a").alias("source_rows"),
            F.col("active_rows_a").alias("filtered_rows"),
            "matched_rows",
            *classes,
            "debt_separation_cases",
        ),
        "rep": report.select("kept_rows", "conflict_accounts"),
    }
    if sb is not None:
        pick["sb"] = sb.select(F.col("rows_s").alias("source_rows"), "matched_rows", *classes)
    if three is not None:
        pick["three"] = three.select("matched_rows", *classes)
    flat = one_row(*[f.select(*[F.col(c).alias(f"{k}_{c}") for c in f.columns]) for k, f in pick.items()])

    def cell(name: str) -> Column:
        return (F.col(name) if name in flat.columns else F.lit(None)).cast("bigint")

    layout = [
        ("source_rows", "ab_source_rows", "sb_source_rows", ""),
        ("filtered_rows", "ab_filtered_rows", "", ""),
        ("counterpart_rows", "rep_kept_rows", "rep_kept_rows" if sb is not None else "", ""),
        ("matched_rows", "ab_matched_rows", "sb_matched_rows", "three_matched_rows"),
        ("perfect", "ab_perfect", "sb_perfect", "three_perfect"),
        ("date_only", "ab_date_only", "sb_date_only", "three_date_only"),
        ("balance_only", "ab_balance_only", "sb_balance_only", "three_balance_only"),
        ("conflict_accounts", "rep_conflict_accounts", "", ""),
        ("debt_separation", "ab_debt_separation_cases", "", ""),
    ]
    lines = F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric"),
                cell(a).alias("a_vs_b"),
                cell(s).alias("s_vs_b"),
                cell(t).alias("three_way"),
            )
            for metric, a, s, t in layout
        ]
    )
    return flat.select(F.explode(lines).alias("r")).select("r.*")

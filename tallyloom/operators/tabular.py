"""Grouping, search, interval, series and nesting operators on ordinary tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import settle

from tallyloom.functions.labels import keyword_class
from tallyloom.operators.literals import literal_rows

# ---- filters and search ---------------------------------------------------


def filter_category(df: DataFrame, column: str, wanted: str) -> DataFrame:
    """Rows of one category; ``all`` keeps everything."""
    return df if wanted == "all" else df.where(F.col(column) == wanted)


def filter_deficit(missions: DataFrame, needs: str, mode: str) -> DataFrame:
    """``all``, rows that need nothing (``complete``), or rows that do (``deficit``)."""
    count = F.coalesce(F.size(needs), F.lit(0))
    return {
        "all": missions,
        "complete": missions.where(count <= 0),
        "deficit": missions.where(count > 0),
    }[mode]


def search_column(df: DataFrame, column: str, term: str) -> DataFrame:
    return df.where(F.contains(F.lower(F.col(column)), F.lit(term.lower())))


def search_any(df: DataFrame, columns: Sequence[Column | str], term: str) -> DataFrame:
    """Rows whose visible text contains the term, ignoring case."""
    return df.where(F.contains(F.lower(F.concat_ws(" ", *columns)), F.lit(term.lower())))


# ---- sums -----------------------------------------------------------------


def sum_map_values(df: DataFrame, column: Column, key: str, total: str) -> DataFrame:
    """Sum of a map column's values per map key."""
    return df.select(F.explode(column).alias(key, "_v")).groupBy(key).agg(F.sum("_v").alias(total))


def sum_by_keyword(
    df: DataFrame, text: str, value: str, classes: Mapping[str, Sequence[str]], otherwise: str
) -> DataFrame:
    """Sum per keyword class; classes without rows are listed with zero."""
    names = [*classes, otherwise]
    sums = df.groupBy(keyword_class(F.col(text), classes, otherwise).alias("class")).agg(F.sum(value).alias("total"))
    every = literal_rows(df.sparkSession, ["class"], [(n,) for n in names])
    return every.join(sums, "class", "left").select("class", F.coalesce("total", F.lit(0)).alias("total"))


def rollup_totals(df: DataFrame, levels: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Sums per group with subtotals and a grand total.

    ``level`` counts the rolled-up columns, so a real null group is told apart.
    """
    aggs = [c.alias(n) for n, c in sums.items()]
    rolled = df.rollup(*levels).agg(F.grouping_id().alias("_g"), *aggs)
    level = F.bit_count("_g").cast("int")
    return rolled.withColumn("level", level).select(*levels, "level", *sums)


def variance(df: DataFrame, by: str, old: Column, new: Column) -> DataFrame:
    """Old and new amounts per group, their difference, and a total row."""
    money = "decimal(38,2)"
    rolled = rollup_totals(df, [by], {"old": F.sum(old), "new": F.sum(new)})
    return rolled.select(
        by,
        "level",
        F.col("old").cast(money).alias("old"),
        F.col("new").cast(money).alias("new"),
        (F.col("new") - F.col("old")).cast(money).alias("difference"),
    )


def share_of_total(df: DataFrame, group: str, value: Column) -> DataFrame:
    """Each group's sum and its part of the whole."""
    sums = df.groupBy(group).agg(F.sum(value).alias("value"))
    total = sums.agg(F.sum("value")).scalar()
    return sums.withColumn("share_pct", F.round(F.try_divide(F.col("value") * 100.0, total), 4))


# ---- intervals ------------------------------------------------------------


def with_span(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.withColumn("span", F.col(end) - F.col(start) + 1)


def explode_years(df: DataFrame, start: str, end: str, year: str = "year") -> DataFrame:
    """One row per year of the interval, both ends included."""
    return df.withColumn(year, F.explode(F.sequence(F.col(start), F.col(end))))


def year_matrix(df: DataFrame, group: str, start: str, end: str, count: str = "rows") -> DataFrame:
    """Number of intervals that cover each year the data has, one row per group and year."""
    return explode_years(df, start, end).groupBy(group, "year").agg(F.count(F.lit(1)).alias(count))


# ---- series ---------------------------------------------------------------


def zip_series(df: DataFrame, index: str, series: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Index-aligned arrays to (index, metric, value) rows."""
    rows = df.select(*keys, F.explode(F.arrays_zip(index, *series)).alias("z")).select(*keys, "z.*")
    return rows.unpivot([*keys, index], list(series), "metric", "value")


def to_long(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide metrics to (ids, metric, value) rows; values as double."""
    wide = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(list(ids), list(metrics), "metric", "value")


def last_value(long: DataFrame, order: str) -> DataFrame:
    """The latest value of every metric."""
    return long.groupBy("metric").agg(F.max_by("value", order).alias("value"), F.max(order).alias(order))


def year_ordinal(df: DataFrame, year: str, keys: Sequence[str]) -> DataFrame:
    """Each key's years, counted from its first; one shuffle.

    A key has no more years than the calendar of the data, so its set stays small.
    """
    sets = df.groupBy(*keys).agg(F.collect_set(year).alias("_years"))
    ordinal = F.col(year) - F.array_min("_years") + 1
    return sets.withColumn(year, F.explode("_years")).withColumn("ordinal", ordinal).drop("_years")


# ---- positions and nesting ------------------------------------------------

# The last position of each phase but the final, open one.
PHASE_ENDS = (4, 6, 11)


def phase_by_position(df: DataFrame, order: Sequence[str], ends: Sequence[int] = PHASE_ENDS) -> DataFrame:
    """Phase of each row by its place in the whole ordered list.

    Only the rows at the phase ends matter: they come from one short top-k list, and
    every row is then placed by comparing its order key with theirs. Nothing is ranked
    globally. ``order`` must be unique.
    """
    key = F.struct(*order)
    head = df.select(*order).orderBy(*order).limit(max(ends))
    place = F.row_number().over(Window.orderBy(*order))  # over max(ends) rows
    marks = (
        head.withColumn("_n", place)
        .agg(*[F.max(F.when(F.col("_n") == e, key)).alias(f"_e{i}") for i, e in enumerate(ends)])
    )
    marks = marks.select(F.struct(*marks.columns).alias("m")).scalar()
    phase = F.lit(len(ends) + 1)
    for i in reversed(range(len(ends))):
        end = F.col("_m")[f"_e{i}"]
        phase = F.when(end.isNull() | (key <= end), F.lit(i + 1)).otherwise(phase)
    return df.withColumn("_m", marks).withColumn("phase", phase).drop("_m")


def nest_links(df: DataFrame, parent: str, child: str, root: str) -> DataFrame:
    """A two-level tree as parent and child links: root to parents, parents to rows.

    Links stay rows; a parent with very many children is never one array.
    """
    top = df.select(F.col(parent).cast("string").alias("child")).distinct().select(
        F.lit(root).alias("parent"), "child", F.lit(1).alias("depth")
    )
    leaves = df.select(
        F.col(parent).cast("string").alias("parent"),
        F.col(child).cast("string").alias("child"),
        F.lit(2).alias("depth"),
    )
    return top.unionByName(leaves)


#: Children of one nested document.
NESTED = 100


def nested_parts(df: DataFrame, parent: str, order: Sequence[str], size: int = NESTED) -> DataFrame:
    """(parent, part, children): the tree as nested documents of at most ``size`` children.

    Children are structs of all other columns, in the order given, which must be unique; part
    ``k`` holds the places ``k * size + 1`` to ``(k + 1) * size`` of its parent. Rows are ordered in
    ranges, so a parent with very many children is spread over many tasks; a row's place is its
    place in its range and the rows of the parent in the ranges before.
    """
    rows = df.select(parent, *order, *(c for c in df.columns if c != parent and c not in order))
    ranged = settle(rows.repartitionByRange(parent, *order).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy(parent, "_range").agg(F.count(F.lit(1)).alias("_n"))
    # As many rows as a parent has ranges.
    before = Window.partitionBy(parent).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy(parent, "_range").orderBy(*order))
    placed = ranged.withColumn("_place", inside).withColumnRenamed(parent, "_parent").withColumnRenamed("_range", "_of")
    same = F.col("_parent").eqNullSafe(F.col(parent)) & (F.col("_of") == F.col("_range"))
    part = F.floor((F.col("_place") + F.col("_before") - 1) / size).cast("bigint")
    child = F.struct(*(c for c in rows.columns if c != parent))
    return (
        placed.join(offsets, same)
        .groupBy(parent, part.alias("part"))
        .agg(F.sort_array(F.collect_list(child)).alias("children"))
    )


def split_list(df: DataFrame, column: str, item: str) -> DataFrame:
    """A comma-separated list to one row per item."""
    return df.withColumn(item, F.explode(F.split(F.col(column), r",\s*"))).drop(column)

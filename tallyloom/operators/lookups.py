"""Lookups: with a default, in two tiers, by a table of terms, along edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.literals import literal_rows


def lookup_with_default(rows: DataFrame, table: DataFrame, on: str, value: str, default: str) -> DataFrame:
    """Left join of a lookup table with unique keys; keys it lacks get the default.

    No broadcast hint: the planner broadcasts a table below its size limit and
    shuffles a larger one.
    """
    return rows.join(table, on, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def lookup_two_tier(
    rows: DataFrame, terms: Sequence[str], value: str, rank: str, default: str = "Unknown"
) -> DataFrame:
    """Per term the first row whose value equals it ignoring case, else the first row
    whose value contains it, else the default.

    ``rank`` is a unique number that orders the rows. Each row lists the terms it
    satisfies; only those pairs are combined, on the map side first.
    """
    wanted = literal_rows(rows.sparkSession, ["term"], [(t,) for t in terms])
    text = F.lower(F.col(value))
    listed = F.array(*[F.lit(t) for t in terms])
    hits = rows.select(
        F.col(rank).alias("rank"),
        text.alias("text"),
        F.col(value).alias("found"),
        F.explode(F.filter(listed, lambda t: F.contains(text, F.lower(t)))).alias("term"),
    )
    apart = F.col("text") != F.lower("term")
    best = hits.groupBy("term").agg(F.min(F.struct(apart.alias("apart"), "rank", "found")).alias("best"))
    found = best.select(
        "term", "best.found", F.col("best.rank").alias(rank), (~F.col("best.apart")).alias("is_exact")
    )
    return wanted.join(found, "term", "left").select(
        "term", F.coalesce("found", F.lit(default)).alias("found"), rank, F.coalesce("is_exact", F.lit(False)).alias("is_exact")
    )


#: Signs of a gram.
GRAM = 3


def grams(text: Column, size: int) -> Column:
    """The different runs of ``size`` signs of a text."""
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(text) - (size - 1), F.lit(1)))
    runs = F.transform(starts, lambda k: F.substring(text, k, F.lit(size)))
    return F.when(F.char_length(text) >= size, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def lookup_terms(rows: DataFrame, terms: DataFrame, term: str, value: str, rank: str, default: str = "Unknown") -> DataFrame:
    """``lookup_two_tier`` for a table of terms of any size: (term, found, rank, is_exact).

    Equal texts count once, by their first row. A term equal to a text is found by a join. Every
    other one is looked for where its rarest gram stands: texts and terms meet by grams of
    ``GRAM`` signs, and ``contains`` verifies each pair. A term no longer than a gram needs no
    pair: the first row of each gram is its answer. Nothing of the terms is in the plan, and no
    join is without keys; a gram that stands in very many texts is rarely any term's rarest
    one, and its joins are split where they lean.

    Defined cases: cases are ignored; null values and terms are left out; an empty term is in every
    text; repeated terms count once; of equal ranks the smaller value comes first.
    """
    first = F.min(F.struct(F.col("rank"), F.col("found"))).alias("first")
    texts = rows.select(F.lower(F.col(value)).alias("text"), F.col(rank).alias("rank"), F.col(value).alias("found"))
    texts = texts.where("text is not null").groupBy("text").agg(first)
    wanted = terms.select(F.col(term).alias("term")).where("term is not null").distinct().withColumn("low", F.lower("term"))
    lows = wanted.select("low").distinct()

    exact = lows.join(texts, F.col("low") == F.col("text")).select("low", "first", F.lit(True).alias("is_exact"))
    inexact = lows.join(exact, "low", "left_anti")

    pieces = F.concat(*(grams(F.col("text"), k) for k in range(1, GRAM + 1)), F.array(F.lit("")))
    of_gram = texts.select("first", F.explode(pieces).alias("gram")).groupBy("gram").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("texts"))
    short = inexact.where(F.char_length("low") <= GRAM).join(of_gram, F.col("low") == F.col("gram"))

    long = inexact.where(F.char_length("low") > GRAM)
    # A gram no text has decides the term at once, so it must take part in the choice.
    told = long.select("low", F.explode(grams(F.col("low"), GRAM)).alias("gram")).join(of_gram.select("gram", "texts"), "gram", "left")
    rarest = told.groupBy("low").agg(F.min(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "gram")).alias("r"))
    rarest = rarest.where("r.texts > 0").select("low", F.col("r.gram").alias("gram"))
    held = texts.select("text", "first", F.explode(grams(F.col("text"), GRAM)).alias("gram"))
    pairs = held.join(rarest, "gram").where(F.contains("text", F.col("low")))
    found = pairs.groupBy("low").agg(F.min("first").alias("first"))

    inside = short.select("low", "first").unionByName(found).withColumn("is_exact", F.lit(False))
    every = exact.unionByName(inside)
    return wanted.join(every, "low", "left").select(
        "term",
        F.coalesce("first.found", F.lit(default)).alias("found"),
        F.col("first.rank").alias(rank),
        F.coalesce("is_exact", F.lit(False)).alias("is_exact"),
    )


def edge_endpoints(edges: DataFrame, nodes: DataFrame, node_id: str, payload: Sequence[str]) -> DataFrame:
    """Edges with the payload of both ends; edges to unknown nodes fall away."""

    def side(name: str) -> DataFrame:
        return nodes.select(F.col(node_id).alias(name), *[F.col(p).alias(f"{name}_{p}") for p in payload])

    return edges.join(side("source"), "source").join(side("target"), "target")
